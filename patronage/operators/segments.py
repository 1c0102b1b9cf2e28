"""Recency, frequency and monetary scores, segments, and revenue concentration."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.columns import (
    elapsed_days,
    fine,
    from_units,
    grand_total,
    round_even,
    timestamp_literal,
    units,
)
from patronage.functions.rules import SEGMENTS, quartile_score, rank_quartile, segment
from patronage.operators.grains import orders
from patronage.operators.profile import reference_date_of
from patronage.operators.ranking import exact_quantiles, quantiles, running_totals
from patronage.session import stage

QUARTILES = (0.25, 0.5, 0.75)

# Campaign per segment (strategy, actions, channel, discount).
CAMPAIGNS = {
    "Champions": (
        "Reward & Advocate",
        [
            "Early access to new collections and flash sales",
            "Referral program with premium incentives (₹500 credit per referral)",
            "VIP events and exclusive loyalty programme perks",
        ],
        "In-app + Personalized email",
        "None needed — value lies in exclusivity",
    ),
    "Loyal Customers": (
        "Upsell & Retain",
        [
            "Loyalty tier upgrade nudge (Silver → Gold benefits preview)",
            "Cross-sell complementary categories (accessories with apparel)",
            "Birthday/anniversary surprise discount (10% off)",
        ],
        "Email + Push notification",
        "10% targeted on cross-sell categories",
    ),
    "Potential Loyalists": (
        "Nurture & Convert",
        [
            "Second-purchase incentive: 15% off within 14 days",
            "Personalized product recommendations based on first purchase",
            "Welcome series drip campaign (3-email sequence)",
        ],
        "Email automation + Retargeting ads",
        "15% off next purchase",
    ),
    "At Risk": (
        "Urgent Win-Back",
        [
            "'We miss you' email campaign with 20% off, 7-day validity",
            "Show 'customers like you bought...' personalized picks",
            "SMS reminder with limited-time free shipping",
        ],
        "Email + SMS + Retargeting",
        "20% off with urgency timer",
    ),
    "Hibernating": (
        "Re-Engage or Release",
        [
            "Deep discount (30% off) with re-engagement survey",
            "New arrivals showcase email (show what they've missed)",
            "If no response in 30 days, move to 'Lost' and reduce spend",
        ],
        "Email + one-time push",
        "30% off",
    ),
    "Lost": (
        "Paid Retargeting or Exclude",
        [
            "Low-cost retargeting ads (social media) with steep discount",
            "If CLV < CAC, exclude from paid campaigns entirely",
            "Survey: 'What made you leave?' for product/service insights",
        ],
        "Paid social (low budget) or suppress",
        "35% off or exclude to save budget",
    ),
    "Need Attention": (
        "Re-activate with Value",
        [
            "Highlight new arrivals in their preferred category",
            "Limited time offer to drive a quick purchase",
            "Feedback request: ask what would bring them back",
        ],
        "Email + Push notification",
        "15% off",
    ),
    "Promising": (
        "Encourage Higher Spend",
        [
            "Bundle offers to increase basket size",
            "Free shipping on orders above a threshold",
            "Product recommendations in higher price ranges",
        ],
        "Email + In-app banners",
        "Free shipping above ₹1,500",
    ),
    "Big Spenders (Lapsed)": (
        "Priority Win-Back",
        [
            "Personal outreach: curated collection email",
            "Exclusive comeback offer with premium positioning",
            "Loyalty points reinstatement if previously active",
        ],
        "Personalized email + Phone (if high CLV)",
        "20% off + bonus loyalty points",
    ),
    "Others": (
        "Monitor & Nudge",
        [
            "Standard email campaigns with personalized content",
            "Track behavior for 30 days before assigning strategy",
            "A/B test different offer types to find best response",
        ],
        "Email",
        "Standard promotional offers",
    ),
}


def compute_rfm(clean: DataFrame, reference_date: datetime | None = None) -> DataFrame:
    reference = timestamp_literal(reference_date or reference_date_of(clean))
    return (
        orders(clean)
        .groupBy("CustomerID")
        .agg(
            F.max("last_line").alias("last_purchase"),
            F.count("InvoiceNo").alias("Frequency"),
            F.sum("amount").alias("amount"),
        )
        .select(
            "CustomerID",
            elapsed_days(F.col("last_purchase"), reference).alias("Recency"),
            "Frequency",
            from_units("amount").alias("Monetary"),
            reference.alias("reference_date"),
        )
    )


def score_rfm(rfm: DataFrame) -> DataFrame:
    """Quartile scores 1..4; recency counts backwards, frequency goes by its rank with
    ties in customer order. Edges are exact, and coinciding edges are allowed."""
    rfm = stage(rfm, "rfm")
    edges = exact_quantiles(rfm, ["Recency", "Monetary"], QUARTILES)  # in the same passes
    recency, monetary = edges["Recency"], edges["Monetary"]
    ranked = running_totals(
        rfm, order="Frequency", tie="CustomerID", rank="_rank", count="_count"
    )
    scored = ranked.select(
        *rfm.columns,
        quartile_score(F.col("Recency"), recency, best_is_low=True).alias("R_Score"),
        rank_quartile(F.col("_rank"), F.col("_count")).alias("F_Score"),
        quartile_score(F.col("Monetary"), monetary).alias("M_Score"),
    )
    scores = ("R_Score", "F_Score", "M_Score")
    return scored.withColumns(
        {
            "RFM_Score": F.concat(*[F.col(s).cast("string") for s in scores]),
            "RFM_Agg_Score": F.col("R_Score") + F.col("F_Score") + F.col("M_Score"),
        }
    )


def map_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn(
        "Segment", segment(F.col("R_Score"), F.col("F_Score"), F.col("M_Score"))
    )


def segment_customers(clean: DataFrame, reference_date: datetime | None = None) -> DataFrame:
    return map_segments(score_rfm(compute_rfm(clean, reference_date)))


def segment_summary(segmented: DataFrame) -> DataFrame:
    customers = stage(
        segmented.where(F.col("Segment").isNotNull()).select(
            "Segment", "Recency", "Frequency", "Monetary"
        ),
        "segments",
    )
    grouped = customers.groupBy("Segment").agg(
        F.count("*").alias("customer_count"),
        F.avg("Recency").alias("avg_recency"),
        F.avg("Frequency").alias("avg_frequency"),
        grand_total(units("Monetary")).alias("amount"),
    )
    medians = quantiles(
        customers.select("Segment", F.col("Monetary").alias("value")), [0.5], ["Segment"]
    ).select("Segment", F.col("q0").alias("median_monetary"))
    # From here on there are at most ten rows.
    everyone = Window.partitionBy()
    revenue = from_units("amount")
    return (
        grouped.join(F.broadcast(medians), "Segment", "left")
        .select(
            "Segment",
            "customer_count",
            "avg_recency",
            "avg_frequency",
            (revenue / F.col("customer_count")).alias("avg_monetary"),
            revenue.alias("total_revenue"),
            "median_monetary",
            round_even(
                F.col("customer_count") / F.sum("customer_count").over(everyone) * 100
            ).alias("pct_customers"),
            round_even(F.try_divide(revenue, from_units(F.sum("amount").over(everyone))) * 100).alias(
                "pct_revenue"
            ),
        )
        .orderBy(F.desc("total_revenue"), "Segment")
    )


def campaigns(spark) -> DataFrame:
    """The campaign table: ten rows."""
    rows = [(name, *campaign) for name, campaign in CAMPAIGNS.items()]
    return spark.createDataFrame(
        rows,
        "Segment string, strategy string, actions array<string>, channel string, discount string",
    )


def with_campaign(df: DataFrame, segment_column: str = "Segment") -> DataFrame:
    """Add the campaign of each row's segment; unknown segments get the default one."""
    name = F.col(segment_column)
    known = F.when(name.isin(*SEGMENTS), name).otherwise(F.lit("Others"))
    lookup = campaigns(df.sparkSession).withColumnRenamed("Segment", "_campaign")
    return (
        df.withColumn("_campaign", known)
        .join(F.broadcast(lookup), "_campaign", "left")
        .select(*df.columns, "strategy", "actions", "channel", "discount")
    )


def validate_h1(segmented: DataFrame) -> DataFrame:
    """Do the customers at or above the 80 % quantile of the score sum bring more than
    60 % of revenue, and are at least 10 % At Risk?"""
    customers = stage(segmented.select("RFM_Agg_Score", "Monetary", "Segment"), "h1")
    cut = exact_quantiles(customers, ["RFM_Agg_Score"], [0.8], few_values=True)["RFM_Agg_Score"][0]
    top = F.col("RFM_Agg_Score") >= cut
    counted = customers.agg(
        F.count("*").alias("customers"),
        grand_total(units("Monetary")).alias("amount"),
        grand_total(F.when(top, units("Monetary"))).alias("top_amount"),
        F.count_if(top).alias("top_customers"),
        F.count_if(F.col("Segment") == "At Risk").alias("at_risk"),
    )
    revenue_share = F.try_divide(from_units("top_amount"), from_units("amount")) * 100
    risk_share = F.try_divide("at_risk", "customers") * 100
    # The wording, the limits and the result names.
    return counted.select(
        F.lit("H1: Top 20% by RFM score contribute >60% of total revenue").alias("hypothesis"),
        round_even(revenue_share).alias("top_20_revenue_pct"),
        F.col("top_customers").alias("top_20_customer_count"),
        (revenue_share > 60).alias("h1_revenue_validated"),
        F.col("at_risk").alias("at_risk_count"),
        round_even(risk_share).alias("at_risk_pct"),
        (risk_share >= 10).alias("h1_at_risk_validated"),
    )


def concentration(df: DataFrame, value: str = "Monetary") -> DataFrame:
    """Customers from the largest value down, with running shares of customers and of
    the total. Ties go by CustomerID; customers without a value are left out."""
    customers = stage(
        df.where(F.col(value).isNotNull())
        .select("CustomerID", value)
        .withColumn("_amount", fine(value)),
        "concentration",
    )
    ranked = running_totals(
        customers,
        order=value,
        tie="CustomerID",
        descending=True,
        sums={"_running": "_amount"},
        rank="_rank",
        count="_count",
        totals={"_total": "_amount"},
    )
    return ranked.select(
        "CustomerID",
        value,
        (
            F.try_divide(F.col("_running").cast("double"), F.col("_total").cast("double")) * 100
        ).alias(
            "cum_revenue_pct"
        ),
        (F.col("_rank") / F.col("_count") * 100).alias("cum_customer_pct"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column occurs, in long form."""
    long = df.select([F.col(c).cast("string").alias(c) for c in columns])
    return (
        long.unpivot([], list(columns), "metric", "value")
        .where(F.col("value").isNotNull())
        .groupBy("metric", "value")
        .agg(F.count("*").alias("customers"))
        .orderBy("metric", "value")
    )


def describe(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles and maximum."""
    long = stage(
        df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
            [], list(columns), "metric", "value"
        ),
        "describe",
    )
    basic = long.groupBy("metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    edges = quantiles(long, QUARTILES, ["metric"])
    joined = basic.join(F.broadcast(edges), "metric", "left").select(
        "metric",
        "count",
        "mean",
        "std",
        "min",
        F.col("q0").alias("p25"),
        F.col("q1").alias("p50"),
        F.col("q2").alias("p75"),
        "max",
    )
    if digits is not None:
        numbers = [c for c in joined.columns if c not in ("metric", "count")]
        joined = joined.withColumns({c: round_even(F.col(c), digits) for c in numbers})
    return joined
