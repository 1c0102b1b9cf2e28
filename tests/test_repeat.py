from __future__ import annotations

import math

import numpy as np
import pytest

from patronage.operators import repeat


def test_series_against_direct_sums():
    for a, b, c, z in ((1.3, 2.2, 3.1, 0.4), (5.0, 7.0, 9.5, 0.9), (0.5, 0.5, 1.5, 0.0)):
        total, term = 0.0, 1.0
        for n in range(5000):
            total += term
            term *= (a + n) * (b + n) / ((c + n) * (n + 1)) * z
        got = repeat.hypergeometric(*(np.array([v]) for v in (a, b, c, z)))[0]
        assert got == pytest.approx(total, rel=1e-10)
    assert repeat.hypergeometric(*(np.array([v]) for v in (1.0, 1.0, 2.0, 0.5)))[0] == pytest.approx(2 * math.log(2))


def test_prediction_is_defined_everywhere(spark):
    schema = "CustomerID bigint, frequency bigint, recency int, T int, monetary_value double"
    rows = [(1, 0, 0, 10, 0.0), (2, 3, 8, 10, 5.0), (3, 1, 0, 0, 2.0), (4, 500, 900, 900, 1.0)]
    df = spark.createDataFrame(rows, schema)
    for a in (0.7, 1.0, 1.4):
        model = repeat.PurchaseModel(0.8, 6.0, a, 2.5)
        found = {r.CustomerID: r for r in repeat.predict_value(df, model, repeat.SpendModel(6, 4, 15)).collect()}
        assert all(math.isfinite(r.predicted_clv) and r.predicted_clv >= 0 for r in found.values())
        assert all(0 < r.prob_alive <= 1 for r in found.values())
        assert found[1].prob_alive == 1
        assert found[1].expected_avg_profit == pytest.approx((5 + 2 + 1) / 3)


def test_predictions_over_a_table_against_direct_sums(spark, small):
    import __spark_entry__ as entry

    r, alpha, a, b = 0.8, 60.0, 1.4, 2.5
    given = {x.CustomerID: x for x in entry.queries()["repeat_summary"](spark, small).collect()}
    found = entry.queries()["value_model_predictions"](spark, small).collect()
    assert found and {x.CustomerID for x in found} == given.keys()
    days = 6 * 30.44
    for row in found:
        x, t_x, age = given[row.CustomerID].frequency, given[row.CustomerID].recency, given[row.CustomerID]["T"]
        z, total, term = days / (alpha + age + days), 0.0, 1.0
        for n in range(2000):
            total += term
            term *= (r + x + n) * (b + x + n) / ((a + b + x - 1 + n) * (n + 1)) * z
        rest = 1 - ((alpha + age) / (alpha + age + days)) ** (r + x) * total
        odds = a / (b + x - 1) * ((alpha + age) / (alpha + t_x)) ** (r + x) if x else 0
        want = (a + b + x - 1) / (a - 1) * rest / (1 + odds)
        assert row.expected_purchases == pytest.approx(want, rel=1e-8)
        assert row.prob_alive == pytest.approx(1 / (1 + odds))
        assert row.predicted_clv == pytest.approx(max(0, want * row.expected_avg_profit * 0.15), rel=1e-8)
