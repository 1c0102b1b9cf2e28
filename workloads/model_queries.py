"""Fitted models over the given tables.

The churn queries fit all the rounds of ``Params``, as the batch run does. The value queries
fit fewer trees (``FEW``): a fit is a chain of small jobs, and its time is the number of trees.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from patronage.operators import charts, churn, models, oversampling, scoring, splitting
from patronage.operators.cleaning import customer_returns
from patronage.session import stage
from workloads.churn_queries import COLUMNS, FEATURES_CTE, PERIODS_CTE
from workloads.registry import query
from workloads.retail import PARAMS, raw_lines, staged_clean, with_clean
from workloads.value_queries import _features

FEW = replace(PARAMS, boosting_rounds=20, regression_trees=40)

SPLIT_SQL = """
SELECT CustomerID, churned,
  ROW_NUMBER() OVER (PARTITION BY churned ORDER BY SUBSTR(MD5(CAST(CustomerID AS VARCHAR)), 1, 13), CustomerID)
    <= FLOOR(COUNT(*) OVER (PARTITION BY churned) * 0.2::DOUBLE + 0.5::DOUBLE) AS is_test
FROM labels_"""


def _churn_tables(spark, sf_dir):
    """Features with return rates, and labels."""
    split = churn.split_periods(staged_clean(spark, sf_dir, *COLUMNS))
    returns = customer_returns(raw_lines(spark, sf_dir), country=PARAMS.country)
    features = stage(churn.churn_features(split.feature, returns), "churn_features")
    return features, stage(churn.churn_labels(split.feature, split.outcome), "churn_labels")


def _churn_models(spark, sf_dir, **options):
    features, labels = _churn_tables(spark, sf_dir)
    return features, labels, models.train_churn(features, labels, PARAMS, **options)


@query(with_clean(PERIODS_CTE) + SPLIT_SQL)
def churn_train_test_split(spark, sf_dir):
    split = churn.split_periods(staged_clean(spark, sf_dir, "CustomerID", "InvoiceDate"))
    labels = stage(churn.churn_labels(split.feature, split.outcome), "churn_labels")
    return splitting.exact_split(labels, "CustomerID", PARAMS.test_share, "churned")


@query(with_clean(PERIODS_CTE, FEATURES_CTE) + """
SELECT churned AS label, COUNT(*) AS customers, (SELECT MAX(c) FROM (
  SELECT COUNT(*) AS c FROM labels_ JOIN feats USING (CustomerID) GROUP BY churned)) AS balanced
FROM labels_ JOIN feats USING (CustomerID) GROUP BY churned""")  # fmt: skip
def churn_class_balance(spark, sf_dir):
    """Customers per class before and after oversampling."""
    features, labels = _churn_tables(spark, sf_dir)
    rows = models.numbers(features, churn.FEATURES).join(labels, "CustomerID")
    rows = rows.select(F.col("CustomerID").alias("id"), F.array(*churn.FEATURES).alias("features"), F.col("churned").alias("label"))
    made = oversampling.oversample(rows, PARAMS.seed, PARAMS.neighbours)
    return made.groupBy("label").agg(F.count_if(~F.col("synthetic")).alias("customers"), F.count("*").alias("balanced"))


@query()
def churn_oversampled(spark, sf_dir):
    """All rows and the new ones of the smaller class; hashes that SQL has not."""
    features, labels = _churn_tables(spark, sf_dir)
    rows = models.numbers(features, churn.FEATURES).join(labels, "CustomerID")
    rows = rows.select(F.col("CustomerID").alias("id"), F.array(*churn.FEATURES).alias("features"), F.col("churned").alias("label"))
    return oversampling.oversample(rows, PARAMS.seed, PARAMS.neighbours)


@query()
def churn_logistic_coefficients(spark, sf_dir):
    """Absolute weights of the scaled features of the logistic regression alone."""
    return _churn_models(spark, sf_dir, smote=False, boosted=False)[2].fitted[0].importance


@query()
def churn_model_comparison(spark, sf_dir):
    return models.churn_comparison(_churn_models(spark, sf_dir)[2])


@query()
def churn_predictions(spark, sf_dir):
    """Probability and risk band of every customer by the chosen model."""
    features, _, found = _churn_models(spark, sf_dir)
    scored = models.churn_scores(found.best().model, features)
    return churn.with_risk_band(scored.select("CustomerID", F.col("score").alias("churn_probability")))


@query()
def hypothesis_churn(spark, sf_dir):
    features, labels, found = _churn_models(spark, sf_dir)
    best = found.best()
    auc = scoring.auc(best.test).first()["auc_roc"]
    return churn.validate_h3(features, labels, best.importance, best.name, auc if auc is not None else float("nan"))


@query()
def churn_top_features(spark, sf_dir):
    best = _churn_models(spark, sf_dir)[2].best()
    return charts.top_features(best.importance)


@query()
def value_model_comparison(spark, sf_dir):
    return models.train_value(_features(staged_clean(spark, sf_dir)), FEW).comparison


@query()
def value_regression_predictions(spark, sf_dir):
    """Spend of every customer by the model of least error: the path without the
    probability models."""
    features = stage(_features(staged_clean(spark, sf_dir)), "clv_features")
    best = models.train_value(features, FEW, boosted=False).best()
    return models.value_scores(best.model, features).select("CustomerID", F.col("score").alias("predicted_clv"))


@query()
def value_actual_and_predicted(spark, sf_dir):
    found = models.train_value(_features(staged_clean(spark, sf_dir)), FEW, boosted=False)
    return charts.actual_and_predicted(found.best().test.select("label", "score"))
