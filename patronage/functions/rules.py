"""Business rules as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of segments, tiers and bands.
SEGMENTS = (
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "At Risk",
    "Hibernating",
    "Lost",
    "Need Attention",
    "Promising",
    "Big Spenders (Lapsed)",
    "Others",
)
TIERS = ("Platinum", "Gold", "Silver", "Bronze")
RISK_BANDS = ("Low", "Medium", "High", "Critical")
HIGH_RISK = ("High", "Critical")
# Upper ends of the first three bands.
RISK_EDGES = (0.3, 0.6, 0.8)
# Weight of a segment in the priority score; 1 for the others.
SEGMENT_WEIGHTS = {
    "At Risk": 3.0,
    "Potential Loyalists": 2.0,
    "Need Attention": 2.0,
    "Loyal Customers": 1.5,
}


def quartile_score(value: Column, edges: Sequence[float], best_is_low: bool = False) -> Column:
    """1..4 by the first quartile edge that is not below the value; null for null."""
    scores = (4, 3, 2, 1) if best_is_low else (1, 2, 3, 4)
    branch = F.when(value.isNull(), F.lit(None))
    branch = branch.when(value <= edges[0], scores[0])
    branch = branch.when(value <= edges[1], scores[1]).when(value <= edges[2], scores[2])
    return branch.otherwise(scores[3]).cast("int")


def rank_quartile(rank: Column, count: Column) -> Column:
    """Quartile 1..4 of a rank 1..count, in whole numbers only."""
    scaled, last = 4 * (rank - 1) + count - 2, count - 1
    whole = (scaled - scaled % last) / last
    return F.when(count > 1, F.greatest(F.lit(1.0), whole)).otherwise(1.0).cast("int")


def segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """A missing score gives Others."""
    fresh, often, large = recency >= 3, frequency >= 3, monetary >= 3
    return (
        F.when(recency.isNull() | frequency.isNull() | monetary.isNull(), "Others")
        .when((recency == 1) & (frequency == 1) & (monetary == 1), "Lost")
        .when((recency == 4) & (frequency == 4) & (monetary == 4), "Champions")
        .when(fresh & often & large, "Loyal Customers")
        .when(fresh & often, "Promising")
        .when(fresh, "Potential Loyalists")
        .when(often & large, "At Risk")
        .when(often, "Need Attention")
        .when(large, "Big Spenders (Lapsed)")
        .otherwise("Hibernating")
    )


def clv_tier(value: Column, edges: Sequence[float]) -> Column:
    """Tier by the 40, 70 and 90 % quantiles, lower ends included; null for null."""
    return (
        F.when(value.isNull(), F.lit(None))
        .when(value >= edges[2], "Platinum")
        .when(value >= edges[1], "Gold")
        .when(value >= edges[0], "Silver")
        .otherwise("Bronze")
    )


def risk_band(probability: Column) -> Column:
    """Right-closed bands over [0, 1]; null outside."""
    low, medium, high = RISK_EDGES
    inside = (probability >= 0) & (probability <= 1)
    return (
        F.when(~inside | probability.isNull(), F.lit(None).cast("string"))
        .when(probability <= low, "Low")
        .when(probability <= medium, "Medium")
        .when(probability <= high, "High")
        .otherwise("Critical")
    )


def segment_weight(name: Column) -> Column:
    branch = None
    for label, weight in SEGMENT_WEIGHTS.items():
        hit = name == label
        branch = F.when(hit, weight) if branch is None else branch.when(hit, weight)
    return branch.otherwise(1.0)


def position_in(value: Column, names: Sequence[str]) -> Column:
    """1-based place of a label in its natural order, for sorting."""
    return F.array_position(F.array(*[F.lit(name) for name in names]), value)
