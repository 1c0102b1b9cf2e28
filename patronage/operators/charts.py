"""Tables behind the charts; drawing itself is left to the reader of the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.ranking import quantiles
from patronage.session import stage

SEGMENT_METRICS = ("avg_recency", "avg_frequency", "avg_monetary")
BINS = 50
MOST_ORDERS = 20


def segment_averages(summary: DataFrame) -> DataFrame:
    """The averages of a segment summary in long form."""
    return summary.select("Segment", *SEGMENT_METRICS).unpivot(
        ["Segment"], list(SEGMENT_METRICS), "metric", "value"
    )


def order_histogram(orders_per_customer: DataFrame, most: int = MOST_ORDERS) -> DataFrame:
    """Customers by number of orders; the last bin holds all larger numbers."""
    return (
        orders_per_customer.groupBy(F.least("order_count", F.lit(most)).alias("orders"))
        .agg(F.count("*").alias("customers"))
        .orderBy("orders")
    )


def histogram(values: DataFrame, by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """``value`` in bins of equal width between the least and the greatest value, per
    group: by, bin, bin_start, rows. Empty bins are absent; equal values are one bin."""
    values = values.where(F.col("value").isNotNull())
    ends = values.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("low"), width)), F.lit(0))
    return (
        values.crossJoin(F.broadcast(ends))
        .groupBy(*by, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("rows"), F.first("low").alias("low"), F.first("high").alias("high"))
        .select(*by, "bin", (F.col("low") + F.col("bin") * width).alias("bin_start"), "rows")
    )


def upper_quantile(values: DataFrame, probability: float = 0.95) -> DataFrame:
    """One row: the quantile at which a chart cuts its axis."""
    return quantiles(values, [probability]).select(F.col("q0").alias("value"))


def box_statistics(values: DataFrame, group: str) -> DataFrame:
    """Quartiles, and the outermost values within 1.5 quartile distances, per group."""
    values = stage(values.where(F.col("value").isNotNull()).select(group, "value"), "box")
    edges = quantiles(values, [0.25, 0.5, 0.75], [group])
    reach = 1.5 * (F.col("q2") - F.col("q0"))
    inside = (F.col("value") >= F.col("q0") - reach) & (F.col("value") <= F.col("q2") + reach)
    return (
        values.join(F.broadcast(edges), group)
        .groupBy(group)
        .agg(
            F.count("*").alias("rows"),
            F.first("q0").alias("q1"),
            F.first("q1").alias("median"),
            F.first("q2").alias("q3"),
            F.min(F.when(inside, F.col("value"))).alias("low"),
            F.max(F.when(inside, F.col("value"))).alias("high"),
        )
    )


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def actual_and_predicted(scored: DataFrame) -> DataFrame:
    """Pairs of ``label`` and ``score`` with the common end of both axes."""
    end = scored.agg(F.max(F.greatest("label", "score")).alias("axis_end"))
    return scored.select(F.col("label").alias("actual"), F.col("score").alias("predicted")).crossJoin(
        F.broadcast(end)
    )
