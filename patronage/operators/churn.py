"""Churn: periods, labels, features, retention actions and the third hypothesis."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.columns import (
    elapsed_days,
    from_units,
    mean_gap_days,
    round_even,
    timestamp_literal,
)
from patronage.functions.rules import RISK_BANDS, position_in, risk_band
from patronage.operators.grains import date_span, orders, products_per_customer
from patronage.params import Params

# Names of the model features.
FEATURES = (
    "recency",
    "frequency",
    "monetary",
    "avg_order_value",
    "avg_days_between_purchases",
    "order_value_trend",
    "unique_products_bought",
    "return_rate",
    "days_since_first_purchase",
    "purchases_last_30_days",
    "purchases_last_60_days",
    "purchase_frequency_change",
    "is_single_purchase_customer",
    "total_quantity",
)
# What to do for a risk band, and what it costs per customer.
RETENTION_ACTIONS = {
    "Low": ("0–30%", "No intervention — standard experience", 0.0),
    "Medium": ("30–60%", "Soft nudge: personalized email + loyalty points reminder", 2.0),
    "High": ("60–80%", "Active retention: 15% discount + 'We miss you' campaign", 8.0),
    "Critical": ("80–100%", "Aggressive win-back: 25% discount + free shipping + call", 15.0),
}


@dataclass(frozen=True)
class ChurnSplit:
    feature: DataFrame
    outcome: DataFrame
    feature_end: datetime
    outcome_end: datetime


def split_periods(
    clean: DataFrame, params: Params = Params(), span: tuple[datetime, datetime] | None = None
) -> ChurnSplit:
    """Lines up to the cut, and lines after it within the outcome window. The cut is a
    share of the whole span in twelfths; the window ends with the data at the latest."""
    first, last = span or date_span(clean)
    days = int((last - first).days * params.feature_months / 12)
    feature_end = first + timedelta(days=days)
    outcome_end = min(feature_end + timedelta(days=params.outcome_days), last)
    when, cut = F.col("InvoiceDate"), timestamp_literal(feature_end)
    return ChurnSplit(
        clean.where(when <= cut),
        clean.where((when > cut) & (when <= timestamp_literal(outcome_end))),
        feature_end,
        outcome_end,
    )


def churn_labels(feature: DataFrame, outcome: DataFrame) -> DataFrame:
    """1 for a customer of the feature period who bought nothing in the outcome window."""
    known = feature.where(F.col("CustomerID").isNotNull()).select("CustomerID").distinct()
    back = outcome.select("CustomerID").distinct().withColumn("_back", F.lit(True))
    return known.join(back, "CustomerID", "left").select(
        "CustomerID", F.col("_back").isNull().cast("int").alias("churned")
    )


def churn_features(
    feature: DataFrame,
    returns: DataFrame | None = None,
    span: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Fourteen features per customer, from one table of orders.

    Recent orders and the two halves of the period are judged by an order's first and
    last line, so an order across the middle counts on both sides. The trend is last
    minus first order value over the number of orders.
    """
    first, last = span or date_span(feature)
    reference = last + timedelta(days=1)
    middle = timestamp_literal(first + timedelta(days=(reference - first).days // 2))
    now = timestamp_literal(reference)
    counted = F.col("InvoiceNo").isNotNull()

    def recent(days: int):
        cut = timestamp_literal(reference - timedelta(days=days))
        return F.count_if(counted & (F.col("last_line") >= cut))

    order = F.when(counted, F.struct("first_line", "InvoiceNo"))
    per_customer = (
        orders(feature)
        .groupBy("CustomerID")
        .agg(
            F.min("first_line").alias("first_purchase"),
            F.max("last_line").alias("last_purchase"),
            F.count("InvoiceNo").alias("frequency"),
            F.sum("amount").alias("amount"),
            F.sum("quantity").alias("total_quantity"),
            recent(30).alias("purchases_last_30_days"),
            recent(60).alias("purchases_last_60_days"),
            (
                F.count_if(counted & (F.col("last_line") > middle))
                - F.count_if(counted & (F.col("first_line") <= middle))
            ).alias("purchase_frequency_change"),
            F.min_by("amount", order).alias("opening"),
            F.max_by("amount", order).alias("latest"),
        )
    )
    joined = per_customer.join(products_per_customer(feature), "CustomerID", "left")
    rate = F.lit(0.0)
    if returns is not None:
        joined = joined.join(returns.select("CustomerID", "return_rate"), "CustomerID", "left")
        rate = F.coalesce("return_rate", F.lit(0.0))
    trend = from_units(F.col("latest") - F.col("opening")) / F.col("frequency")
    return joined.select(
        "CustomerID",
        elapsed_days(F.col("last_purchase"), now).alias("recency"),
        "frequency",
        from_units("amount").alias("monetary"),
        F.coalesce("products", F.lit(0)).alias("unique_products_bought"),
        "total_quantity",
        F.try_divide(from_units("amount"), "frequency").alias("avg_order_value"),
        elapsed_days(F.col("first_purchase"), now).alias("days_since_first_purchase"),
        (F.col("frequency") == 1).cast("int").alias("is_single_purchase_customer"),
        mean_gap_days("first_purchase", "last_purchase", "frequency").alias(
            "avg_days_between_purchases"
        ),
        "purchases_last_30_days",
        "purchases_last_60_days",
        "purchase_frequency_change",
        F.when(F.col("frequency") > 1, trend).otherwise(F.lit(0.0)).alias("order_value_trend"),
        rate.alias("return_rate"),
    )


def with_risk_band(scored: DataFrame, probability: str = "churn_probability") -> DataFrame:
    return scored.withColumn("churn_risk_band", risk_band(F.col(probability)))


def retention_actions(spark) -> DataFrame:
    """The four-row action table."""
    rows = [(band, *action) for band, action in RETENTION_ACTIONS.items()]
    return spark.createDataFrame(
        rows,
        "risk_level string, probability_range string, action string, "
        "estimated_cost_per_customer double",
    )


def band_distribution(scored: DataFrame, band: str = "churn_risk_band") -> DataFrame:
    """Customers and share per band with its action; a band without customers has 0. The
    share is of all rows, banded or not."""
    spark = scored.sparkSession
    counts = scored.groupBy(F.col(band).alias("risk_level")).agg(F.count("*").alias("customers"))
    total = counts.agg(F.sum("customers").alias("total"))
    grid = retention_actions(spark).join(F.broadcast(counts), "risk_level", "left")
    customers = F.coalesce("customers", F.lit(0))
    return (
        grid.crossJoin(F.broadcast(total))
        .select(
            "risk_level",
            "probability_range",
            customers.alias("customers"),
            round_even(F.try_divide(customers, "total") * 100).alias("pct"),
            "action",
            "estimated_cost_per_customer",
            (customers * F.col("estimated_cost_per_customer")).alias("total_cost"),
        )
        .orderBy(position_in(F.col("risk_level"), RISK_BANDS))
    )


def validate_h3(
    features: DataFrame,
    labels: DataFrame,
    importance: DataFrame,
    model: str,
    auc: float,
    single: str = "is_single_purchase_customer",
) -> DataFrame:
    """Do more than 70 % of single-order customers churn, and are the return rate and the
    order value trend among the five strongest features (feature, importance)?"""
    rate = (
        features.join(labels, "CustomerID")
        .where(F.col(single) == 1)
        .agg(F.avg("churned").alias("share"))
        .select((F.col("share") * 100).alias("rate"))
    )
    top: Sequence = [r["feature"] for r in importance.orderBy(F.desc("importance"), "feature").limit(5).collect()]
    names = F.array(*[F.lit(n) for n in top]).cast("array<string>")
    # The wording, the limit and the result names.
    return rate.select(
        F.lit(
            "H3: Single-purchase customers have >70% churn, return_rate in top-5 features"
        ).alias("hypothesis"),
        round_even(F.col("rate")).alias("single_purchase_churn_rate"),
        (F.col("rate") > 70).alias("h3_churn_validated"),
        names.alias("top_5_features"),
        F.array_contains(names, "return_rate").alias("return_rate_in_top5"),
        F.array_contains(names, "order_value_trend").alias("order_value_trend_in_top5"),
        F.lit(model).alias("best_model"),
        round_even(F.lit(float(auc)), 4).alias("best_auc"),
    )
