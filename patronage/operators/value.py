"""Customer lifetime value: time split, repeat-purchase summary, features, tiers, budget."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.columns import (
    elapsed_days,
    fine_sum,
    from_units,
    mean_gap_days,
    round_even,
    timestamp_literal,
    units,
)
from patronage.functions.rules import TIERS, clv_tier, position_in
from patronage.operators.grains import date_span, orders, products_per_customer
from patronage.operators.profile import reference_date_of
from patronage.operators.ranking import exact_quantiles, quantiles
from patronage.params import Params
from patronage.session import stage

TIER_QUANTILES = (0.4, 0.7, 0.9)
FEATURES = (
    "recency",
    "frequency",
    "monetary",
    "avg_order_value",
    "unique_products",
    "total_quantity",
    "tenure_days",
    "avg_days_between",
    "items_per_order",
)


@dataclass(frozen=True)
class ValueSplit:
    calibration: DataFrame
    holdout: DataFrame
    split_date: datetime


def split_calibration(
    clean: DataFrame, params: Params = Params(), span: tuple[datetime, datetime] | None = None
) -> ValueSplit:
    """Cut the time span by the ratio of the two parts; the cut itself is calibration."""
    first, last = span or date_span(clean)
    parts = params.calibration_months + params.holdout_months
    days = int((last - first).days * params.calibration_months / parts)
    split = first + timedelta(days=days)
    cut = timestamp_literal(split)
    return ValueSplit(
        clean.where(F.col("InvoiceDate") <= cut), clean.where(F.col("InvoiceDate") > cut), split
    )


def repeat_summary(calibration: DataFrame, split_date: datetime) -> DataFrame:
    """Repeat orders, days from first to last purchase, age at the split, and mean
    value of what was bought after the first timestamp.

    "After" is tested per line, so an invoice with two timestamps can count in part.
    The first timestamp of a customer is not known before aggregation; instead of
    joining it back to the lines, revenue and finished orders are summed per customer
    and timestamp, and the earliest timestamp is taken off the totals. Every step is an
    aggregate with a partial step, so a customer with very many lines stays spread out.
    """
    lines = (
        calibration.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID", "InvoiceNo", "InvoiceDate")
        .agg(F.sum(units("Revenue")).alias("amount"))
    )
    per_order = lines.groupBy("CustomerID", "InvoiceNo").agg(
        F.min("InvoiceDate").alias("begin"),
        F.max("InvoiceDate").alias("end"),
        F.sum("amount").alias("amount"),
        F.min_by("amount", "InvoiceDate").alias("begin_amount"),
    )
    counted = F.when(F.col("InvoiceNo").isNotNull(), 1).otherwise(0).cast("bigint")
    zero = F.lit(0).cast("bigint")
    moments = per_order.select(
        "CustomerID",
        F.explode(
            F.array(
                F.struct(
                    F.col("begin").alias("moment"),
                    F.col("begin_amount").alias("opened"),
                    zero.alias("finished"),
                    F.col("amount").alias("amount"),
                    counted.alias("orders"),
                ),
                F.struct(
                    F.col("end").alias("moment"),
                    zero.alias("opened"),
                    counted.alias("finished"),
                    zero.alias("amount"),
                    zero.alias("orders"),
                ),
            )
        ).alias("m"),
    ).select("CustomerID", "m.*")
    per_moment = moments.groupBy("CustomerID", "moment").agg(
        *[F.sum(c).alias(c) for c in ("opened", "finished", "amount", "orders")]
    )
    at_first = F.min_by(F.struct("opened", "finished"), "moment")
    per_customer = per_moment.groupBy("CustomerID").agg(
        F.min("moment").alias("first_purchase"),
        F.max("moment").alias("last_purchase"),
        F.sum("amount").alias("amount"),
        F.sum("orders").alias("orders"),
        at_first.alias("at_first"),
    )
    later_amount = F.col("amount") - F.col("at_first.opened")
    later_orders = F.col("orders") - F.col("at_first.finished")
    return per_customer.select(
        "CustomerID",
        (F.col("orders") - 1).alias("frequency"),
        elapsed_days("first_purchase", "last_purchase").alias("recency"),
        elapsed_days(F.col("first_purchase"), timestamp_literal(split_date)).alias("T"),
        F.coalesce(F.try_divide(from_units(later_amount), later_orders), F.lit(0.0)).alias(
            "monetary_value"
        ),
    )


def clv_features(
    calibration: DataFrame, holdout: DataFrame, reference_date: datetime | None = None
) -> DataFrame:
    """Calibration features per customer, and revenue in the holdout as the target."""
    reference = timestamp_literal(reference_date or reference_date_of(calibration))
    per_customer = (
        orders(calibration)
        .groupBy("CustomerID")
        .agg(
            F.min("first_line").alias("first_purchase"),
            F.max("last_line").alias("last_purchase"),
            F.count("InvoiceNo").alias("frequency"),
            F.sum("amount").alias("amount"),
            F.sum("quantity").alias("total_quantity"),
        )
    )
    spend = (
        holdout.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(F.sum(units("Revenue")).alias("holdout_amount"))
    )
    return (
        per_customer.join(products_per_customer(calibration), "CustomerID", "left")
        .join(spend, "CustomerID", "left")
        .select(
            "CustomerID",
            elapsed_days(F.col("last_purchase"), reference).alias("recency"),
            "frequency",
            from_units("amount").alias("monetary"),
            F.try_divide(from_units("amount"), "frequency").alias("avg_order_value"),
            F.coalesce("products", F.lit(0)).alias("unique_products"),
            "total_quantity",
            elapsed_days(F.col("first_purchase"), reference).alias("tenure_days"),
            mean_gap_days("first_purchase", "last_purchase", "frequency").alias(
                "avg_days_between"
            ),
            F.try_divide("total_quantity", "frequency").alias("items_per_order"),
            from_units(F.coalesce("holdout_amount", F.lit(0))).alias("holdout_revenue"),
        )
    )


def assign_tiers(df: DataFrame, column: str = "predicted_clv") -> tuple[DataFrame, DataFrame]:
    """Rows with ``CLV_Tier``, and the tier boundaries as a four-row table, whose bounds
    are null when no row has a value."""
    df = stage(df, "tiers")
    edges = exact_quantiles(df, [column], TIER_QUANTILES)[column]
    low, middle, high = (None if e is None else f"£{e:.2f}" for e in edges)
    empty = low is None
    # Tier names and the wording of their boundaries.
    bounds = [
        ("Platinum", edges[2], None, None if empty else f"> {high}"),
        ("Gold", edges[1], edges[2], None if empty else f"{middle} – {high}"),
        ("Silver", edges[0], edges[1], None if empty else f"{low} – {middle}"),
        ("Bronze", None, edges[0], None if empty else f"< {low}"),
    ]
    table = df.sparkSession.createDataFrame(
        bounds, "CLV_Tier string, lower_bound double, upper_bound double, label string"
    )
    return df.withColumn("CLV_Tier", clv_tier(F.col(column), edges)), table


def validate_h2(
    df: DataFrame, params: Params = Params(), column: str = "predicted_clv"
) -> DataFrame:
    """Are at least 30 % of customers worth less than they cost to acquire?"""
    cost = params.cac / params.cac_per_currency_unit
    values = stage(df.select(F.col(column).alias("value")), "h2")
    counted = values.agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("value") < cost).alias("unprofitable"),
        F.try_divide(fine_sum("value"), F.count("value")).alias("mean"),
    )
    share = F.try_divide("unprofitable", "customers") * 100
    # The wording, the limit and the result names.
    return counted.crossJoin(F.broadcast(quantiles(values, [0.5]))).select(
        F.lit(
            "H2: At current CAC, ≥30% of customers are unprofitable over 6-month horizon"
        ).alias("hypothesis"),
        F.lit(params.cac).alias("cac_inr"),
        round_even(F.lit(cost)).alias("cac_gbp"),
        F.col("unprofitable").alias("unprofitable_count"),
        round_even(share).alias("unprofitable_pct"),
        (share >= 30).alias("h2_validated"),
        round_even(F.col("mean")).alias("mean_clv"),
        round_even(F.col("q0")).alias("median_clv"),
    )


def budget_by_tier(
    df: DataFrame, params: Params = Params(), column: str = "predicted_clv"
) -> DataFrame:
    """Value against acquisition cost per tier, best tier first."""
    cost = params.cac / params.cac_per_currency_unit
    tiers = stage(
        df.where(F.col("CLV_Tier").isNotNull()).select("CLV_Tier", F.col(column).alias("value")),
        "budget",
    )
    grouped = tiers.groupBy("CLV_Tier").agg(
        F.count("*").alias("customer_count"),
        F.try_divide(fine_sum("value"), F.count("value")).alias("avg_clv"),
        fine_sum("value").alias("total_clv"),
    )
    medians = quantiles(tiers, [0.5], ["CLV_Tier"]).select(
        "CLV_Tier", F.col("q0").alias("median_clv")
    )
    return (
        grouped.join(F.broadcast(medians), "CLV_Tier", "left")
        .select(
            "CLV_Tier",
            "customer_count",
            "avg_clv",
            "median_clv",
            "total_clv",
            F.lit(cost).alias("cac_gbp"),
            (F.col("avg_clv") - cost).alias("profit_per_customer"),
            round_even(F.try_divide(F.lit(cost), "avg_clv") * 100).alias("cac_as_pct_of_clv"),
            (F.col("avg_clv") - cost > 0).alias("is_profitable"),
        )
        .orderBy(position_in(F.col("CLV_Tier"), TIERS))
    )
