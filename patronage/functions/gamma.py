"""Logarithm and derivative of the gamma function as column expressions.

Both shift a positive argument up by ``SHIFT`` and use the asymptotic series there; the
error is below 1e-11 for arguments of 1e-6 and more.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 8
# Coefficients of the series in 1/y, 1/y^3, ... (Bernoulli numbers over their places).
_LOG = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
_DERIVATIVE = (-1 / 12, 1 / 120, -1 / 252, 1 / 240, -1 / 132)


def _series(y: Column, coefficients: tuple[float, ...]) -> Column:
    """The coefficients times 1, y^-2, y^-4, ..., nested."""
    square = 1 / (y * y)
    total = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        total = F.lit(c) + square * total
    return total


def log_gamma(x: Column) -> Column:
    y = x + float(SHIFT)
    rising = x
    for i in range(1, SHIFT):
        rising = rising * (x + float(i))
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + _series(y, _LOG) / y - F.ln(rising)


def digamma(x: Column) -> Column:
    y = x + float(SHIFT)
    below = 1 / x
    for i in range(1, SHIFT):
        below = below + 1 / (x + float(i))
    return F.ln(y) - 0.5 / y + _series(y, _DERIVATIVE) / (y * y) - below
