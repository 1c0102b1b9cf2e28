from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.operators import models, scoring
from patronage.operators.churn import FEATURES
from patronage.params import Params
from workloads import model_queries

SHORT = replace(Params(), boosting_rounds=15, regression_trees=10)


def churn_rows(spark, n=600, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, len(FEATURES))) * np.arange(1, len(FEATURES) + 1) + 3
    x[:, 7] = 5.0  # a constant feature
    label = (x[:, 0] - 3 + 0.5 * (x[:, 1] - 3) + rng.logistic(0, 0.5, n) > 0.8).astype(int)
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    features = spark.createDataFrame(rows, "CustomerID bigint, " + ", ".join(f"{c} double" for c in FEATURES))
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(label)], "CustomerID bigint, churned int")
    return features, labels


def newton(x, y, weight):
    """Ridge logistic regression on scaled columns, penalty on all but the intercept."""
    scale = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(scale > 0, scale, 1)
    z = np.column_stack([z, np.ones(len(z))])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    theta = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ theta))
        slope = z.T @ (weight * (p - y)) + ridge @ theta
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge
        theta -= np.linalg.solve(curve, slope)
    return theta


@pytest.mark.parametrize("weighted", [False, True])
def test_logistic_coefficients_equal_newton(spark, weighted):
    features, labels = churn_rows(spark)
    rows = features.join(labels, "CustomerID").withColumn("label", F.col("churned").cast("double"))
    if weighted:
        rows = models.balanced_weights(rows)
    model = models.fit_logistic(rows, FEATURES, Params(), "weight" if weighted else None).stages[-1]
    table = rows.orderBy("CustomerID").toPandas()
    weight = table["weight"].to_numpy() if weighted else np.ones(len(table))
    want = newton(table[list(FEATURES)].to_numpy(), table["label"].to_numpy(), weight)
    assert model.coefficients.toArray() == pytest.approx(want[:-1], abs=1e-4)
    assert model.intercept == pytest.approx(want[-1], abs=1e-4)


def test_churn_models_find_the_signal(spark):
    features, labels = churn_rows(spark)
    odd = spark.createDataFrame([(9000 + i, 1) for i in range(3)], "CustomerID bigint, churned int")
    found = models.train_churn(features, labels.unionByName(odd), SHORT)
    assert [f.name for f in found.fitted] == [models.LOGISTIC, models.BOOSTED]
    assert found.best().name == models.BOOSTED
    table = {r["model"]: r for r in models.churn_comparison(found).collect()}
    assert all(r["auc_roc"] > 0.8 and r["f1"] > 0.7 for r in table.values())
    for f in found.fitted:
        assert f.test.count() in (119, 120, 121)
        top = f.importance.orderBy(F.desc("importance")).first()["feature"]
        assert top in FEATURES[:2]  # of equal effect
        assert f.importance.where(F.col("feature") == FEATURES[7]).first()["importance"] == pytest.approx(0)
    scored = models.churn_scores(found.best().model, features.withColumn(FEATURES[2], F.lit(None).cast("double")))
    assert scored.where("score between 0 and 1").count() == features.count()
    weighted = models.train_churn(features, labels, SHORT, smote=False, boosted=False)
    assert weighted.balance == "class weights" and len(weighted.fitted) == 1
    assert scoring.auc(weighted.fitted[0].test).first()["auc_roc"] > 0.8


@pytest.mark.parametrize("name", ["churn_predictions", "hypothesis_churn"])
def test_churn_queries_ask_for_all_rounds(spark, monkeypatch, name):
    asked, boosted = [], models.GBTClassifier

    def short(**options):
        asked.append((options["maxIter"], options["maxDepth"], options["stepSize"], options["subsamplingRate"]))
        return boosted(**{**options, "maxIter": 2})

    tables = churn_rows(spark, 200)
    monkeypatch.setattr(models, "GBTClassifier", short)
    monkeypatch.setattr(model_queries, "_churn_tables", lambda *_: tables)
    rows = getattr(model_queries, name)(spark, "").collect()
    assert asked == [(300, 5, 0.05, 0.8)]
    assert len(rows) == (200 if name == "churn_predictions" else 1)


def test_both_classes_are_needed(spark):
    features, labels = churn_rows(spark, 50)
    with pytest.raises(ValueError):
        models.train_churn(features, labels.withColumn("churned", F.lit(1)), SHORT)


def test_value_models(spark):
    rng = np.random.default_rng(6)
    names = models.VALUE_FEATURES
    x = rng.normal(10, 3, (400, len(names)))
    y = 4 * x[:, 2] - 2 * x[:, 0] + np.where(x[:, 1] > 10, 30, 0) + rng.normal(0, 1, 400)
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(
        rows, "CustomerID bigint, " + ", ".join(f"{c} double" for c in names) + ", holdout_revenue double"
    )
    found = models.train_value(df, replace(SHORT, learning_rate=0.3))
    table = {r["model"]: r for r in found.comparison.collect()}
    assert set(table) == {models.LINEAR, models.FOREST, models.BOOSTED}
    best = found.best()
    assert table[best.name]["mae"] == min(r["mae"] for r in table.values())
    assert all(math.isfinite(v) for r in table.values() for v in (r["mae"], r["rmse"], r["r2"]))
    linear = found.fitted[0]
    tested = {r.CustomerID for r in linear.test.collect()}
    train = np.array([i not in tested for i in range(400)])
    z = np.column_stack([x, np.ones(400)])
    want = np.linalg.lstsq(z[train], y[train], rcond=None)[0]
    assert linear.model.stages[-1].coefficients.toArray() == pytest.approx(want[:-1], abs=1e-6)
    for r in linear.test.collect():
        assert r.score == pytest.approx(max(0.0, z[r.CustomerID] @ want), abs=1e-6)
