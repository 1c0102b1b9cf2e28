"""Repeat purchases and spend as probability models with given parameters.

Purchases: Fader, Hardie and Lee (2005), parameters r, alpha, a, b. Spend: Fader and
Hardie (2013), parameters p, q, v.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.params import Params


TERMS = 1_000_000


@dataclass(frozen=True)
class PurchaseModel:
    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class SpendModel:
    p: float
    q: float
    v: float


def probability_alive(model: PurchaseModel) -> Column:
    """From frequency, recency and T; 1 without a repeat purchase."""
    x = F.col("frequency").cast("double")
    ratio = (F.lit(model.alpha) + F.col("T")) / (F.lit(model.alpha) + F.col("recency"))
    odds = F.lit(model.a) / (F.lit(model.b) + x - 1) * F.pow(ratio, F.lit(model.r) + x)
    return F.when(x > 0, 1 / (1 + odds)).otherwise(F.lit(1.0))


def expected_profit(model: SpendModel) -> Column:
    """Mean value of a purchase: a customer's own mean drawn towards that of all."""
    px = F.lit(model.p) * F.col("frequency")
    own = px / (px + F.lit(model.q - 1))
    return own * F.col("monetary_value") + (1 - own) * F.lit(model.p * model.v / (model.q - 1))


def hypergeometric(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss's series for 0 <= z < 1, summed until a term no longer counts."""
    return _summed(a, b, c, z)[0]


def _summed(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The series, and its slope in ``c`` with the sign turned. Entries leave when their
    terms no longer count; a series that does not end within ``TERMS`` is an error."""
    a, b, c, z = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, c, z)))
    total, turned = np.ones(z.shape), np.zeros(z.shape)
    own = np.arange(len(z))
    term, inverse = np.ones(len(z)), np.zeros(len(z))
    for n in range(TERMS):
        if not len(own):
            return total, turned
        inverse = inverse + 1 / (c[own] + n)
        term = term * (a[own] + n) * (b[own] + n) / ((c[own] + n) * (n + 1)) * z[own]
        total[own] += term
        turned[own] += term * inverse
        counts = np.abs(term) * np.maximum(1, inverse) > 1e-14 * (1 - z[own]) * np.abs(total[own])
        own, term, inverse = own[counts], term[counts], inverse[counts]
    raise ArithmeticError(f"{len(own)} series did not end within {TERMS} terms")


def expected_purchases(model: PurchaseModel, days: float):
    """Purchases in the next ``days`` days, from frequency, recency and T."""
    r, alpha, a, b = model.r, model.alpha, model.a, model.b
    near_one = abs(a - 1) < 1e-7  # there the formula is 0 / 0, and its limit is used

    @F.pandas_udf("double")
    def purchases(x: pd.Series, recency: pd.Series, age: pd.Series) -> pd.Series:
        x, recency, age = (s.to_numpy(dtype=float) for s in (x, recency, age))
        z = days / (alpha + age + days)
        kept = ((alpha + age) / (alpha + age + days)) ** (r + x)
        if near_one:
            mean = (b + x) * kept * _summed(r + x, b + x, b + x, z)[1]
        else:
            mean = (a + b + x - 1) / (a - 1) * (1 - kept * hypergeometric(r + x, b + x, a + b + x - 1, z))
        odds = np.where(x > 0, a / np.maximum(b + x - 1, 1e-12) * ((alpha + age) / (alpha + recency)) ** (r + x), 0)
        return pd.Series(mean / (1 + odds))

    return purchases("frequency", "recency", "T")


def predict_value(
    summary: DataFrame, purchases: PurchaseModel, spend: SpendModel, params: Params = Params()
) -> DataFrame:
    """The summary with expected purchases, probability alive, profit per purchase and the
    value over the horizon. Customers without repeat purchases get the mean value of those
    with; so do customers with repeat purchases and a mean value of 0 or less, for which
    the spend model is not defined (a choice; the formula itself would draw their 0 towards
    the mean of all). A value is at least 0."""
    repeat = (F.col("frequency") > 0) & (F.col("monetary_value") > 0)
    mean = summary.where(repeat).agg(F.avg("monetary_value").alias("_mean"))
    days = params.horizon_months * params.days_per_month
    scored = summary.crossJoin(F.broadcast(mean)).select(
        *summary.columns,
        expected_purchases(purchases, days).alias("expected_purchases"),
        probability_alive(purchases).alias("prob_alive"),
        F.coalesce(F.when(repeat, expected_profit(spend)), "_mean", F.lit(0.0)).alias("expected_avg_profit"),
    )
    value = F.col("expected_purchases") * F.col("expected_avg_profit") * params.profit_margin
    return scored.withColumn("predicted_clv", F.greatest(F.lit(0.0), value))
