"""Metrics and business impact of a probability score against a 0/1 label.

Inputs have the columns ``label`` and ``score``; rows without either are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.columns import round_even
from patronage.operators.ranking import running_totals
from patronage.params import Params
from patronage.session import stage

# Thresholds of the sweep.
THRESHOLDS = tuple(i / 20 for i in range(1, 20))


def _usable(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("label").isNotNull() & F.col("score").isNotNull())


def _cells(scored: DataFrame, threshold: float) -> DataFrame:
    flagged, positive = F.col("score") >= threshold, F.col("label") == 1
    return _usable(scored).agg(
        F.count_if(flagged & positive).alias("tp"),
        F.count_if(flagged & ~positive).alias("fp"),
        F.count_if(~flagged & positive).alias("fn"),
        F.count_if(~flagged & ~positive).alias("tn"),
    )


def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Four rows (actual, predicted, customers); empty cells are 0."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("customers"))
            for a, p, c in cells
        ]
    )
    return _cells(scored, threshold).select(F.explode(rows).alias("r")).select("r.*")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def classification_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted
    averages. A ratio without a denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    counts = _cells(scored, threshold).select(
        "*",
        _ratio(tn, tn + fn).alias("p0"),
        _ratio(tn, tn + fp).alias("r0"),
        (tn + fp).alias("n0"),
        _ratio(tp, tp + fp).alias("p1"),
        _ratio(tp, tp + fn).alias("r1"),
        (tp + fn).alias("n1"),
    )
    p0, r0, n0, p1, r1, n1 = (F.col(c) for c in ("p0", "r0", "n0", "p1", "r1", "n1"))
    f0, f1 = _ratio(2 * p0 * r0, p0 + r0), _ratio(2 * p1 * r1, p1 + r1)
    total = n0 + n1
    accuracy = _ratio(tp + tn, total)

    def weighted(a: Column, b: Column) -> Column:
        return _ratio(a * n0 + b * n1, total)

    rows = [
        ("0", p0, r0, f0, n0),
        ("1", p1, r1, f1, n1),
        ("accuracy", accuracy, accuracy, accuracy, total),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        ("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    ]
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                p.alias("precision"),
                r.alias("recall"),
                f.alias("f1_score"),
                n.alias("support"),
            )
            for name, p, r, f, n in rows
        ]
    )
    return counts.select(F.explode(table).alias("r")).select("r.*")


def _running(scored: DataFrame) -> DataFrame:
    """One row per distinct score, highest first, with running and total counts."""
    table = _usable(scored).groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") != 1).alias("negatives"),
    )
    return running_totals(
        stage(table, "scores"),
        order="score",
        descending=True,
        sums={"cum_positives": "positives", "cum_negatives": "negatives"},
        totals={"all_positives": "positives", "all_negatives": "negatives"},
    )


def roc_points(scored: DataFrame) -> DataFrame:
    """One point per distinct score, and the origin, whose threshold is null."""
    points = _running(scored).select(
        F.try_divide("cum_negatives", "all_negatives").alias("fpr"),
        F.try_divide("cum_positives", "all_positives").alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = scored.sparkSession.createDataFrame([(0.0, 0.0, None)], "fpr double, tpr double, threshold double")
    return origin.unionByName(points)


def auc(scored: DataFrame) -> DataFrame:
    """Area under the curve; a tie counts one half. Null with one class only."""
    above = F.col("cum_positives") - F.col("positives")
    won = F.col("negatives").cast("decimal(20,0)") * (2 * above + F.col("positives")).cast("decimal(20,0)")
    total = _running(scored).agg(
        F.sum(won).cast("double").alias("won"),
        F.max("all_positives").cast("double").alias("p"),
        F.max("all_negatives").cast("double").alias("n"),
    )
    return total.select(F.try_divide("won", 2 * F.col("p") * F.col("n")).alias("auc_roc"))


def _impact(tp: Column, fp: Column, fn: Column, tn: Column, params: Params) -> list[Column]:
    flagged = tp + fp
    cost = flagged * F.lit(params.intervention_cost)
    recovered = F.floor(tp * F.lit(params.recovery_rate)).cast("bigint")
    saved = recovered * F.lit(params.customer_revenue)
    return [
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        fn.alias("false_negatives"),
        tn.alias("true_negatives"),
        flagged.alias("total_interventions"),
        round_even(cost).alias("cost_of_interventions"),
        recovered.alias("recovered_churners"),
        round_even(saved).alias("revenue_saved"),
        round_even(fn * F.lit(params.customer_revenue)).alias("missed_revenue"),
        round_even(saved - cost).alias("net_roi"),
        F.coalesce(round_even(F.try_divide(saved, cost)), F.lit(0.0)).alias("roi_multiple"),
    ]


def business_impact(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """What acting on everyone at or above the threshold costs and saves."""
    cells = _cells(scored, params.decision_threshold)
    return cells.select(
        F.lit(params.decision_threshold).alias("threshold"),
        *_impact(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"), params),
    )


def threshold_sweep(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """The impact at nineteen thresholds. Every row is counted once, by how many
    thresholds it reaches; the rest is done on those forty counts."""
    reached = F.lit(0)
    for threshold in THRESHOLDS:
        reached = reached + (F.col("score") >= threshold).cast("int")
    counts = (
        _usable(scored)
        .groupBy(reached.alias("reached"))
        .agg(
            F.count_if(F.col("label") == 1).alias("positives"),
            F.count_if(F.col("label") != 1).alias("negatives"),
        )
    )
    grid = scored.sparkSession.createDataFrame(
        [(i, t) for i, t in enumerate(THRESHOLDS, 1)], "place int, threshold double"
    )
    hit = F.col("reached") >= F.col("place")
    cells = (
        grid.crossJoin(F.broadcast(counts))
        .groupBy("threshold")
        .agg(
            F.sum(F.when(hit, F.col("positives")).otherwise(0)).alias("tp"),
            F.sum(F.when(hit, F.col("negatives")).otherwise(0)).alias("fp"),
            F.sum(F.when(hit, 0).otherwise(F.col("positives"))).alias("fn"),
            F.sum(F.when(hit, 0).otherwise(F.col("negatives"))).alias("tn"),
        )
    )
    return cells.select(
        "threshold", *_impact(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"), params)
    ).orderBy("threshold")


def regression_metrics(scored: DataFrame) -> DataFrame:
    """MAE, RMSE and R2 of ``score`` against a numeric ``label``."""
    error = F.col("label") - F.col("score")
    moments = _usable(scored).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop("label").alias("variance"),
    )
    return moments.select(
        "mae",
        F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide("mse", "variance")).alias("r2"),
    )
