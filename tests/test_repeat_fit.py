from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.functions.gamma import digamma, log_gamma
from patronage.operators import repeat, repeat_fit
from patronage.params import Params

SUMMARY = "CustomerID bigint, frequency bigint, recency int, T int, monetary_value double"


def test_gamma_expressions(spark):
    values = [1e-6, 0.01, 0.3, 1.0, 1.5, 2.0, 7.9, 40.0, 1234.5, 1e6]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for r in rows.select("x", log_gamma(F.col("x")).alias("g"), digamma(F.col("x")).alias("d")).collect():
        assert r.g == pytest.approx(math.lgamma(r.x), rel=1e-11, abs=1e-11)
        h = 1e-4 * r.x
        slope = (math.lgamma(r.x + h) - math.lgamma(r.x - h)) / (2 * h)
        assert r.d == pytest.approx(slope, rel=1e-6, abs=1e-6)


def purchases_loss(rows, v, scale, penalizer):
    """The objective in plain Python, customer by customer."""
    r, alpha, a, b = v
    total = 0.0
    for x, s, t in rows:
        s, t = s * scale, t * scale
        part = math.lgamma(r + x) - math.lgamma(r) + r * math.log(alpha)
        part += math.lgamma(a + b) + math.lgamma(b + x) - math.lgamma(b) - math.lgamma(a + b + x)
        live = -(r + x) * math.log(alpha + t)
        if x:
            dead = math.log(a) - math.log(b + x - 1) - (r + x) * math.log(alpha + s)
            live = max(live, dead) + math.log1p(math.exp(-abs(live - dead)))
        total += part + live
    return -total / len(rows) + penalizer * sum(p * p for p in v)


def spend_loss(rows, v, penalizer):
    p, q, w = v
    total = 0.0
    for x, m in rows:
        total += math.lgamma(p * x + q) - math.lgamma(p * x) - math.lgamma(q) + q * math.log(w)
        total += (p * x - 1) * math.log(m) + p * x * math.log(x) - (p * x + q) * math.log(x * m + w)
    return -total / len(rows) + penalizer * sum(c * c for c in v)


def flat(loss, point):
    """Is the loss at its least here, by differences in the logarithm of each number? Nobody
    leaves in the given tables, so two of the numbers make next to no difference."""
    for i in range(len(point)):
        up, down = list(point), list(point)
        up[i], down[i] = point[i] * math.exp(1e-3), point[i] * math.exp(-1e-3)
        here = loss(point)
        assert min(loss(up), loss(down)) > here - 1e-9
        assert abs(loss(up) - loss(down)) / 2e-3 < 2e-5


def test_the_optimum_is_that_of_a_plain_computation(spark, small):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    rows = entry.queries()["repeat_summary"](spark, sf).collect()
    found = {r["name"]: r["value"] for r in entry.queries()["purchase_model_fit"](spark, sf).collect()}
    given = [(r.frequency, r.recency, r["T"]) for r in rows]
    assert found["customers"] == len(rows) and found["left_out"] == 0
    scale = 10 / max(t for _, _, t in given)
    point = [found["r"], found["alpha"] * scale, found["a"], found["b"]]
    flat(lambda v: purchases_loss(given, v, scale, 0.01), point)
    spent = [(r.frequency, r.monetary_value) for r in rows if r.frequency > 0 and r.monetary_value > 0]
    found = {r["name"]: r["value"] for r in entry.queries()["spend_model_fit"](spark, sf).collect()}
    assert found["customers"] == len(spent)
    flat(lambda v: spend_loss(spent, v, 0.01), [found["p"], found["q"], found["v"]])
    valued = entry.queries()["value_model_fitted"](spark, small).collect()
    assert len(valued) == entry.queries()["repeat_summary"](spark, small).count() and all(0 <= v.predicted_clv < math.inf for v in valued)
    assert all(0 < v.prob_alive <= 1 for v in valued)


def simulated(n, r, alpha, a, b, days, seed):
    rng = np.random.default_rng(seed)
    rate = rng.gamma(r, 1 / alpha, n)
    quits = rng.beta(a, b, n)
    age = rng.uniform(0.5 * days, days, n)
    x, last, now, alive = np.zeros(n, int), np.zeros(n), np.zeros(n), np.ones(n, bool)
    while alive.any():
        now = now + rng.exponential(1 / rate)
        alive &= now < age
        x[alive] += 1
        last[alive] = now[alive]
        alive &= rng.random(n) >= quits
    return x, last, age


def test_known_parameters_come_back(spark):
    r, alpha, a, b = 1.2, 9.0, 1.5, 4.0
    x, last, age = simulated(100_000, r, alpha, a, b, 300.0, 4)
    rng = np.random.default_rng(9)
    p, q, v = 4.0, 5.0, 12.0
    mean = rng.gamma(p * np.maximum(x, 1), 1.0) / np.maximum(x, 1) / rng.gamma(q, 1 / v, len(x))
    rows = spark.createDataFrame(
        [(int(i), float(s), float(t), float(m)) for i, s, t, m in zip(x, last, age, mean)],
        "frequency bigint, recency double, T double, monetary_value double",
    )
    free = Params(penalizer=0.0)
    found = repeat_fit.fit_purchases(rows, free).model
    assert [found.r, found.alpha, found.a, found.b] == pytest.approx([r, alpha, a, b], rel=0.06)
    # Nearer to the data than the true numbers are.
    given = list(zip(x[:20000].tolist(), last[:20000].tolist(), age[:20000].tolist()))
    near = purchases_loss(given, [found.r, found.alpha, found.a, found.b], 1, 0)
    assert near < purchases_loss(given, [r, alpha, a, b], 1, 0) + 2e-4
    spend = repeat_fit.fit_spend(rows, free).model
    assert [spend.p, spend.q, spend.v] == pytest.approx([p, q, v], rel=0.03)


def test_awkward_rows(spark):
    good = [(i, i % 4, (i % 4) * 9, 40, 5.0 + i % 7 if i % 4 else 0.0) for i in range(200)]
    bad = [(900, None, 1, 5, 1.0), (901, 2, 50, 40, 3.0), (902, 1, 5, None, float("nan")), (903, 2, 4, 9, -1.0)]
    plain = spark.createDataFrame(good, SUMMARY)
    mixed = spark.createDataFrame(good + bad, SUMMARY)
    one, other = repeat_fit.fit_spend(plain), repeat_fit.fit_spend(mixed)
    assert (other.customers, other.left_out) == (one.customers + 1, 2)
    fit = repeat_fit.fit_purchases(mixed)
    assert (fit.customers, fit.left_out) == (201, 3)
    again = repeat_fit.fit_purchases(mixed.repartition(7))
    assert vars(again.model) == pytest.approx(vars(fit.model), rel=1e-6)


def test_nothing_to_fit(spark):
    with pytest.raises(repeat_fit.NotFitted):
        repeat_fit.fit_purchases(spark.createDataFrame([], SUMMARY))
    with pytest.raises(repeat_fit.NotFitted):
        repeat_fit.fit_spend(spark.createDataFrame([(1, 0, 0, 5, 0.0)], SUMMARY))


def test_the_limit_at_one_and_series_that_do_not_end(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 0, 0, 10, 0.0), (2, 3, 8, 10, 5.0), (3, 60, 300, 300, 5.0)], SUMMARY)
    at = lambda a: [
        r.e
        for r in rows.select("CustomerID", repeat.expected_purchases(repeat.PurchaseModel(0.8, 6.0, a, 2.5), 180.0).alias("e"))
        .orderBy("CustomerID")
        .collect()
    ]
    middle = [(x + y) / 2 for x, y in zip(at(1 - 1e-4), at(1 + 1e-4))]
    assert at(1.0) == pytest.approx(middle, rel=1e-7)
    monkeypatch.setattr(repeat, "TERMS", 20_000)
    with pytest.raises(ArithmeticError):
        repeat._summed(*(np.array([v]) for v in (5.0, 9.0, 6.0, 1 - 1e-9)))


def test_one_repeat_without_value_gets_the_mean(spark):
    rows = spark.createDataFrame([(1, 1, 5, 10, 0.0), (2, 2, 5, 10, 8.0), (3, 1, 5, 10, 4.0)], SUMMARY)
    model = repeat.SpendModel(6, 4, 15)
    found = {r.CustomerID: r for r in repeat.predict_value(rows, repeat.PurchaseModel(0.8, 6, 1.4, 2.5), model).collect()}
    assert found[1].expected_avg_profit == pytest.approx(6.0)
