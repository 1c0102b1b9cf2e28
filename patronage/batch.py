"""The whole customer run: from raw lines to published tables, reports and models.

A run writes into a folder of its own, step by step. Steps read what earlier steps wrote,
and what a step stages is deleted when it ends. A step that ended leaves a mark, so a run
that failed goes on where it stopped. When all steps have ended, one small file is
replaced, which names the run that readers should see: they see all of the old run or all
of the new one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.operators import churn, cleaning, master, models, profile, repeat, repeat_fit, scoring, segments, value
from patronage.params import Params
from patronage.session import exists, replace_text, stage, staging
from patronage.sources import tables

CURRENT = "CURRENT"


@dataclass(frozen=True)
class Run:
    """Where one run reads and writes."""

    spark: SparkSession
    raw: DataFrame
    folder: str
    params: Params
    fmt: str = "parquet"

    def write(self, df: DataFrame, name: str) -> None:
        tables.write_table(df, self.folder, name, self.fmt)

    def read(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.folder, name, self.fmt)

    def report(self, df: DataFrame, name: str) -> None:
        tables.write_report(df, self.folder, name)

    def save(self, model, name: str) -> None:
        tables.save_model(model, f"{self.folder}/models", name)

    def typed(self, name: str, df: DataFrame) -> DataFrame:
        """The declared columns of an output table in their order and types."""
        fields = tables.table_schema(name).fields
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def clean_step(run: Run) -> None:
    raw = stage(run.raw, "raw")
    run.write(run.typed("cleaned_transactions", cleaning.clean_transactions(raw, run.params)), "cleaned_transactions")
    run.report(cleaning.cleaning_report(raw, run.params), "cleaning_report")
    returns = cleaning.customer_returns(raw, run.params.country)
    run.write(returns.select("CustomerID", "return_rate", "cancelled_orders"), "customer_returns")


def customers_step(run: Run) -> None:
    clean = run.read("cleaned_transactions")
    run.write(run.typed("customer_table", profile.customer_table(clean)), "customer_table")
    run.write(run.typed("cohort_retention", profile.cohort_retention(clean)), "cohort_retention")


def segments_step(run: Run) -> None:
    scored = run.typed("rfm_scored", segments.segment_customers(run.read("cleaned_transactions")))
    run.write(scored, "rfm_scored")
    scored = run.read("rfm_scored")
    run.write(run.typed("segment_summary", segments.segment_summary(scored)), "segment_summary")
    run.write(run.typed("pareto_analysis", segments.concentration(scored)), "pareto_analysis")
    run.report(segments.validate_h1(scored), "h1")


def fitted_values(summary: DataFrame, params: Params) -> DataFrame:
    """Values and tiers from the models fitted on the summary."""
    summary = stage(summary, "summary")
    purchases = repeat_fit.fit_purchases(summary, params).model
    spend = repeat_fit.fit_spend(summary, params).model
    return value.assign_tiers(repeat.predict_value(summary, purchases, spend, params))[0]


def value_step(run: Run) -> None:
    """Values by the probability models. Where those cannot be fitted or evaluated, values
    come from the regression of least error, and there is no table ``clv_statistical``."""
    split = value.split_calibration(run.read("cleaned_transactions"), run.params)
    run.write(run.typed("clv_features", value.clv_features(split.calibration, split.holdout)), "clv_features")
    features = run.read("clv_features")
    found = models.train_value(features, run.params)
    best = found.best()
    run.save(best.model, "clv_best_model")
    run.write(found.comparison.withColumn("best", F.col("model") == best.name), "clv_model_comparison")
    try:
        valued = fitted_values(value.repeat_summary(split.calibration, split.split_date), run.params)
        run.write(run.typed("clv_statistical", valued), "clv_statistical")
        valued = run.read("clv_statistical")
    except (repeat_fit.NotFitted, ArithmeticError):
        model = tables.load_model(f"{run.folder}/models", "clv_best_model")
        scored = models.value_scores(model, features).withColumnRenamed("score", "predicted_clv")
        valued = value.assign_tiers(scored)[0]
    run.write(valued.select("CustomerID", "predicted_clv", "CLV_Tier"), "customer_values")
    valued = run.read("customer_values")
    run.write(run.typed("budget_analysis", value.budget_by_tier(valued, run.params)), "budget_analysis")
    run.report(value.validate_h2(valued, run.params), "h2")


def churn_step(run: Run) -> None:
    split = churn.split_periods(run.read("cleaned_transactions"), run.params)
    features = churn.churn_features(split.feature, run.read("customer_returns"))
    run.write(run.typed("churn_features", features), "churn_features")
    features = run.read("churn_features")
    labels = stage(churn.churn_labels(split.feature, split.outcome), "labels")
    found = models.train_churn(features, labels, run.params)
    for fitted in found.fitted:
        run.save(fitted.model, "churn_" + fitted.name.lower().replace(" ", "_"))
    run.write(models.churn_comparison(found, run.params.decision_threshold), "churn_model_comparison")
    best = found.best()
    model = tables.load_model(f"{run.folder}/models", "churn_" + best.name.lower().replace(" ", "_"))
    scored = models.churn_scores(model, features).withColumnRenamed("score", "churn_probability")
    run.write(run.typed("churn_predictions", churn.with_risk_band(scored)), "churn_predictions")
    run.write(run.typed("threshold_sweep", scoring.threshold_sweep(best.test, run.params)), "threshold_sweep")
    run.report(scoring.business_impact(best.test, run.params), "business_impact")
    auc = scoring.auc(best.test).first()["auc_roc"]
    h3 = churn.validate_h3(
        features, labels, best.importance, best.name, float("nan") if auc is None else auc
    )
    run.report(h3, "h3")
    run.report(master.hypothesis_table(h3), "h3_table")


def master_step(run: Run) -> None:
    table = master.master_table(run.read("rfm_scored"), run.read("customer_values"), run.read("churn_predictions"))
    run.write(run.typed("master_customer_table", table), "master_customer_table")
    top = master.top_priority(run.read("master_customer_table"), run.params)
    run.write(run.typed("priority_top_50", top), "priority_top_50")


def hypotheses_step(run: Run) -> None:
    """One table of all hypotheses. The features named by the third are one text there."""
    rows = [tables.read_report(run.spark, run.folder, name) for name in ("h1", "h2")]
    together = master.hypothesis_table(*rows).unionByName(tables.read_report(run.spark, run.folder, "h3_table"))
    run.report(together, "hypothesis_results")


STEPS: tuple[tuple[str, Callable[[Run], None]], ...] = (
    ("clean", clean_step),
    ("customers", customers_step),
    ("segments", segments_step),
    ("value", value_step),
    ("churn", churn_step),
    ("master", master_step),
    ("hypotheses", hypotheses_step),
)


def run_batch(
    raw: DataFrame,
    root: str,
    run_id: str,
    params: Params = Params(),
    fmt: str = "parquet",
    steps: Sequence[tuple[str, Callable[[Run], None]]] = STEPS,
) -> str:
    """Run all steps that have not ended yet under ``root``/runs/``run_id`` and publish
    the run. The same id goes on with a run that stopped; a new id starts anew."""
    spark = raw.sparkSession
    folder = f"{root.rstrip('/')}/runs/{run_id}"
    run = Run(spark, raw, folder, params, fmt)
    for name, step in steps:
        mark = f"{folder}/_ended/{name}"
        if exists(spark, mark):
            continue
        with staging(spark):
            step(run)
        replace_text(spark, mark, name)
    replace_text(spark, f"{root.rstrip('/')}/{CURRENT}", run_id)
    return folder


def current_run(spark: SparkSession, root: str) -> str:
    """The folder of the published run."""
    root = root.rstrip("/")
    if not exists(spark, f"{root}/{CURRENT}"):
        raise FileNotFoundError(f"no run is published under {root}")
    return f"{root}/runs/{spark.read.text(f'{root}/{CURRENT}').first()['value']}"


def load_current(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return tables.read_table(spark, current_run(spark, root), name, fmt)


def export_selection(spark: SparkSession, root: str, target: str, fmt: str = "csv", **wanted) -> str:
    """Write the chosen customers of the published master table (see
    ``master.select_customers``) as a download."""
    chosen = master.select_customers(load_current(spark, root, "master_customer_table"), **wanted)
    return tables.write_table(chosen, target, "selected_customers", fmt)


def few_trees(params: Params) -> Params:
    """The same run with short model fits, for trials."""
    return replace(params, boosting_rounds=3, regression_trees=5, regression_boost_depth=3, churn_boost_depth=3)
