"""The master customer table and the reports on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.columns import fine_sum
from patronage.functions.rules import HIGH_RISK, RISK_BANDS, TIERS, position_in, segment_weight
from patronage.params import Params

TOP_TIERS = ("Platinum", "Gold")


def master_table(rfm: DataFrame, clv: DataFrame, churn: DataFrame) -> DataFrame:
    """All segmented customers with value and churn risk. Customers missing there get
    value 0, tier Bronze, probability 0.5 and band Medium."""
    joined = (
        rfm.withColumnRenamed("Segment", "RFM_Segment")
        .select(
            "CustomerID", "Recency", "Frequency", "Monetary", "R_Score", "F_Score", "M_Score",
            "RFM_Score", "RFM_Agg_Score", "RFM_Segment",
        )
        .join(clv.select("CustomerID", "predicted_clv", "CLV_Tier"), "CustomerID", "left")
        .join(
            churn.select(
                "CustomerID", "churn_probability", F.col("churn_risk_band").alias("Churn_Risk_Band")
            ),
            "CustomerID",
            "left",
        )
    )
    filled = joined.na.fill(
        {"predicted_clv": 0.0, "churn_probability": 0.5, "CLV_Tier": "Bronze", "Churn_Risk_Band": "Medium"}
    )
    score = F.col("predicted_clv") * F.col("churn_probability") * segment_weight(F.col("RFM_Segment"))
    return filled.withColumn("priority_score", score)


def top_priority(master: DataFrame, params: Params = Params()) -> DataFrame:
    """The customers of highest priority; the lower CustomerID wins a tie."""
    return master.orderBy(F.desc("priority_score"), "CustomerID").limit(params.top_customers)


def _in(column: str, names: Sequence[str]) -> Column:
    return F.col(column).isin(*names)


def _risky() -> Column:
    return _in("Churn_Risk_Band", HIGH_RISK)


def insights(master: DataFrame) -> DataFrame:
    """Customers and their value in each of the four action groups."""
    segment = F.col("RFM_Segment")
    # Which customers each group holds.
    groups = {
        "highest_priority": (segment == "At Risk") & _in("CLV_Tier", TOP_TIERS) & _risky(),
        "leave_alone": (segment == "Champions") & (F.col("Churn_Risk_Band") == "Low"),
        "let_go": _in("RFM_Segment", ("Lost", "Hibernating"))
        & (F.col("CLV_Tier") == "Bronze")
        & _risky(),
        "nurture": (segment == "Potential Loyalists") & _in("Churn_Risk_Band", ("Medium", "Low")),
    }
    wide = master.agg(
        *[F.count_if(c).alias(f"n_{g}") for g, c in groups.items()],
        *[fine_sum(F.when(c, F.col("predicted_clv"))).alias(f"v_{g}") for g, c in groups.items()],
    )
    rows = [
        F.struct(
            F.lit(g).alias("insight"),
            F.col(f"n_{g}").alias("customers"),
            F.coalesce(f"v_{g}", F.lit(0.0)).alias("total_clv"),
        )
        for g in groups
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def revenue_at_risk(master: DataFrame) -> DataFrame:
    return master.agg(
        F.count_if(_risky()).alias("customers"),
        F.coalesce(fine_sum(F.when(_risky(), F.col("predicted_clv"))), F.lit(0.0)).alias("total_clv"),
    )


def revenue_at_risk_by_segment(master: DataFrame) -> DataFrame:
    return (
        master.where(_risky())
        .groupBy("RFM_Segment")
        .agg(F.count("*").alias("customers"), fine_sum("predicted_clv").alias("total_clv"))
        .orderBy(F.desc("total_clv"), "RFM_Segment")
    )


def combinations(master: DataFrame) -> DataFrame:
    """Customers per tier, band and segment, for combinations that occur."""
    return (
        master.groupBy("CLV_Tier", "Churn_Risk_Band", "RFM_Segment")
        .agg(F.count("*").alias("customers"))
        .orderBy(
            position_in(F.col("CLV_Tier"), TIERS),
            position_in(F.col("Churn_Risk_Band"), RISK_BANDS),
            "RFM_Segment",
        )
    )


def select_customers(
    master: DataFrame,
    segments: Sequence[str] = (),
    tiers: Sequence[str] = (),
    bands: Sequence[str] = (),
) -> DataFrame:
    """Customers of the wanted segments, tiers and bands; an empty list means all."""
    for column, wanted in (("RFM_Segment", segments), ("CLV_Tier", tiers), ("Churn_Risk_Band", bands)):
        if wanted:
            master = master.where(_in(column, wanted))
    return master


def selection_size(master: DataFrame, **wanted) -> DataFrame:
    shown = select_customers(master, **wanted).agg(F.count("*").alias("shown"))
    return shown.crossJoin(F.broadcast(master.agg(F.count("*").alias("total"))))


def flagged(scored: DataFrame, threshold: float, probability: str = "churn_probability") -> DataFrame:
    """Customers at or above a threshold, and those below it."""
    hit = F.col(probability) >= threshold
    return scored.agg(F.count_if(hit).alias("flagged"), F.count_if(~hit).alias("kept"))


def summary_cards(master: DataFrame) -> DataFrame:
    """Headline numbers of the master table; the mean is revenue per customer."""
    return master.agg(
        F.count("*").alias("customers"),
        fine_sum("Monetary").alias("total_revenue"),
        F.try_divide(fine_sum("Monetary"), F.count("Monetary")).alias("revenue_per_customer"),
        *[F.count_if(F.col("CLV_Tier") == t).alias(f"{t.lower()}_customers") for t in TIERS],
    )


def hypothesis_table(*results: DataFrame) -> DataFrame:
    """All one-row hypothesis results in long form: hypothesis, metric, value as text."""
    table = None
    for result in results:
        names = [c for c in result.columns if c != "hypothesis"]
        text = [
            (F.array_join(c, ", ") if dict(result.dtypes)[c].startswith("array") else F.col(c).cast("string")).alias(c)
            for c in names
        ]
        long = result.select("hypothesis", *text).unpivot(["hypothesis"], names, "metric", "value")
        table = long if table is None else table.unionByName(long)
    return table
