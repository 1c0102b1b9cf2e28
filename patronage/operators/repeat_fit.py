"""Fitting the purchase and spend models by penalised maximum likelihood.

Customers are grouped by what the likelihood depends on and counted; the groups are
written once. Every pass adds up likelihoods and slopes of a few parameter vectors as
columns, and the driver, which holds four (or three) numbers, takes damped Newton steps in
the logarithms of the parameters. Vectors come in as rows of a small table, so that all
passes run the same compiled plan. The objective is the mean negative log-likelihood plus
``penalizer`` times the sum of the squared parameters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.gamma import digamma, log_gamma
from patronage.operators.repeat import PurchaseModel, SpendModel
from patronage.params import Params
from patronage.session import stage

# A parameter may run to 0 (nobody leaves, say): there the logarithm is cut off.
EDGES = (-20.0, 30.0)

Evaluate = Callable[[Sequence[np.ndarray]], list[tuple[float, np.ndarray]]]


class NotFitted(ValueError):
    """There is nothing to fit on, or the likelihood has no maximum within bounds."""


@dataclass(frozen=True)
class Fit:
    """A fitted model, its mean log-likelihood, the customers it rests on, those left out
    because the likelihood is not defined for them, and the passes over the data."""

    model: PurchaseModel | SpendModel
    log_likelihood: float
    customers: int
    left_out: int
    passes: int


def minimise(evaluate: Evaluate, start: np.ndarray, rounds: int = 60, tolerance: float = 1e-7) -> tuple[np.ndarray, float]:
    """The point of least value. ``evaluate`` gives (value, slope) for several points at
    once. Curvature comes from slopes a little apart; a direction of negative curvature
    is turned round, steps are at most 2 long, and the best of several is taken."""
    point, width = np.array(start, dtype=float), 1e-6
    steps = (1.0, 0.5, 0.1, 0.01)
    for _ in range(rounds):
        shifts = [point + width * e for e in np.eye(len(point))]
        (value, slope), *around = evaluate([point, *shifts])
        if np.abs(slope).max() < tolerance:
            break
        curve = np.array([(a[1] - slope) / width for a in around])
        values, vectors = np.linalg.eigh((curve + curve.T) / 2)
        scale = np.maximum(np.abs(values), 1e-6 * max(1.0, np.abs(values).max()))
        move = -vectors @ ((vectors.T @ slope) / scale)
        move *= min(1.0, 2.0 / max(np.abs(move).max(), 1e-300))
        tried = evaluate([point + s * move for s in steps])
        best = min(range(len(steps)), key=lambda i: tried[i][0] if math.isfinite(tried[i][0]) else math.inf)
        if not tried[best][0] < value:
            break
        point = point + steps[best] * move
        if value - tried[best][0] < 1e-7 * max(1.0, abs(value)):
            break
    return point, evaluate([point])[0][0]


class _Likelihood:
    """Mean penalised likelihood of a staged table with a count in ``weight``."""

    def __init__(self, groups: DataFrame, names: Sequence[str], value: Column, slopes: Sequence[Column], penalizer: float):
        self.groups, self.names, self.penalizer = groups, list(names), penalizer
        weight = F.col("weight").cast("double")
        self.sums = [F.sum(weight * value).alias("value")]
        self.sums += [F.sum(weight * s).alias(f"d_{n}") for n, s in zip(names, slopes)]
        self.customers = groups.agg(F.sum("weight").alias("n")).first()["n"] or 0
        self.passes = 0

    def __call__(self, points: Sequence[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        natural = [np.exp(np.clip(p, *EDGES)) for p in points]
        rows = [(i, *map(float, v)) for i, v in enumerate(natural)]
        schema = "point int, " + ", ".join(f"{n} double" for n in self.names)
        vectors = self.groups.sparkSession.createDataFrame(rows, schema)
        # A dozen rows at most meet every group; one row per vector comes back.
        summed = self.groups.crossJoin(F.broadcast(vectors)).groupBy("point").agg(*self.sums).collect()
        found = {r["point"]: r for r in summed}
        self.passes += 1
        out = []
        for i, v in enumerate(natural):
            r = found[i]
            value = -r["value"] / self.customers + self.penalizer * float(v @ v)
            slope = np.array([-r[f"d_{n}"] / self.customers for n in self.names]) + 2 * self.penalizer * v
            out.append((value if math.isfinite(value) else math.inf, slope * v))
        return out

    def fit(self, start: Sequence[float]) -> tuple[np.ndarray, float]:
        point, value = minimise(self, np.log(np.array(start, dtype=float)))
        parameters = np.exp(np.clip(point, *EDGES))
        if not math.isfinite(value) or point.max() > 25:
            raise NotFitted("the likelihood has no maximum within bounds")
        return parameters, self.penalizer * float(parameters @ parameters) - value


def fit_purchases(
    summary: DataFrame, params: Params = Params(), time_scale: float | None = None
) -> Fit:
    """The purchase model of a repeat summary (frequency, recency, T).

    Time is multiplied by ``time_scale`` before the fit (default: the greatest T becomes
    10), which matters for what the penalty does, and ``alpha`` is scaled back. Rows
    without any of the three values, or with recency above T, are left out and counted.
    """
    x, s, t = (F.col(c).cast("double") for c in ("frequency", "recency", "T"))
    usable = (x >= 0) & (s >= 0) & (s <= t)
    counted = stage(
        summary.select(x.alias("x"), s.alias("s"), t.alias("t"), F.coalesce(usable, F.lit(False)).alias("usable"))
        .groupBy("x", "s", "t", "usable")
        .agg(F.count("*").alias("weight")),
        "purchase_groups",
    )
    totals = counted.agg(
        F.max(F.when(F.col("usable"), F.col("t"))).alias("last"),
        F.coalesce(F.sum(F.when(~F.col("usable"), F.col("weight"))), F.lit(0)).alias("left_out"),
    ).first()
    if totals["last"] is None:
        raise NotFitted("no customers to fit the purchase model on")
    scale = time_scale or (10 / totals["last"] if totals["last"] > 0 else 1.0)
    groups = counted.where("usable").select("x", (F.col("s") * scale).alias("s"), (F.col("t") * scale).alias("t"), "weight")
    r, alpha, a, b, x, s, t = (F.col(c) for c in ("r", "alpha", "a", "b", "x", "s", "t"))
    known = F.greatest(x, F.lit(1.0))
    dead = F.ln(a) - F.ln(b + known - 1) - (r + x) * F.ln(alpha + s)
    live = -(r + x) * F.ln(alpha + t)
    top = F.when(x > 0, F.greatest(dead, live)).otherwise(live)
    died = F.when(x > 0, F.exp(dead - top)).otherwise(F.lit(0.0))
    lived = F.exp(live - top)
    share = died / (died + lived)
    value = (
        log_gamma(r + x) - log_gamma(r) + r * F.ln(alpha)
        + log_gamma(a + b) + log_gamma(b + x) - log_gamma(b) - log_gamma(a + b + x)
        + top + F.ln(died + lived)
    )
    both = digamma(a + b) - digamma(a + b + x)
    slopes = [
        digamma(r + x) - digamma(r) + F.ln(alpha) - (1 - share) * F.ln(alpha + t) - share * F.ln(alpha + s),
        r / alpha - (r + x) * ((1 - share) / (alpha + t) + share / (alpha + s)),
        both + share / a,
        both + digamma(b + x) - digamma(b) - share / (b + known - 1),
    ]
    likelihood = _Likelihood(groups, ("r", "alpha", "a", "b"), value, slopes, params.penalizer)
    (r, alpha, a, b), mean = likelihood.fit((1.0, 1.0, 1.0, 1.0))
    model = PurchaseModel(float(r), float(alpha / scale), float(a), float(b))
    return Fit(model, mean, likelihood.customers, totals["left_out"], likelihood.passes)


def fit_spend(summary: DataFrame, params: Params = Params()) -> Fit:
    """The spend model of customers with a repeat purchase (frequency, monetary_value).
    A mean value of 0 or less has no likelihood: such customers are left out and counted."""
    x, m = F.col("frequency").cast("double"), F.col("monetary_value").cast("double")
    usable = F.coalesce((m > 0) & ~F.isnan(m), F.lit(False))
    counted = stage(
        summary.where(x > 0)
        .select(x.alias("x"), m.alias("m"), usable.alias("usable"))
        .groupBy("x", "m", "usable")
        .agg(F.count("*").alias("weight")),
        "spend_groups",
    )
    totals = counted.agg(
        F.coalesce(F.sum(F.when(F.col("usable"), F.col("weight"))), F.lit(0)).alias("used"),
        F.coalesce(F.sum(F.when(~F.col("usable"), F.col("weight"))), F.lit(0)).alias("left_out"),
    ).first()
    if not totals["used"]:
        raise NotFitted("no repeat customers to fit the spend model on")
    p, q, v, x, m = (F.col(c) for c in ("p", "q", "v", "x", "m"))
    px, whole = p * x, x * m + v
    value = (
        log_gamma(px + q) - log_gamma(px) - log_gamma(q) + q * F.ln(v)
        + (px - 1) * F.ln(m) + px * F.ln(x) - (px + q) * F.ln(whole)
    )
    slopes = [
        x * (digamma(px + q) - digamma(px) + F.ln(m) + F.ln(x) - F.ln(whole)),
        digamma(px + q) - digamma(q) + F.ln(v) - F.ln(whole),
        q / v - (px + q) / whole,
    ]
    likelihood = _Likelihood(counted.where("usable"), ("p", "q", "v"), value, slopes, params.penalizer)
    (p, q, v), mean = likelihood.fit((1.0, 1.0, 1.0))
    return Fit(SpendModel(float(p), float(q), float(v)), mean, likelihood.customers, totals["left_out"], likelihood.passes)


def fit_table(spark, fit: Fit) -> DataFrame:
    """One row per parameter, then the likelihood and the counts: (name, value)."""
    rows = [(k, float(v)) for k, v in vars(fit.model).items()]
    rows += [
        ("mean_log_likelihood", fit.log_likelihood),
        ("customers", float(fit.customers)),
        ("left_out", float(fit.left_out)),
    ]
    return spark.createDataFrame(rows, "name string, value double")
