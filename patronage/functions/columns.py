"""Column helpers shared by the operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money is added up as whole ten-thousandths: the sum is exact, does not depend on the
# order of rows, and stays inside generated code. BIGINT holds the sums of an order or a
# customer (up to 9e14 currency units); wider sums go through ``grand_total``.
UNITS = 10_000


def units(amount: Column | str) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.rint(amount * F.lit(float(UNITS))).cast("bigint")


def from_units(total: Column | str) -> Column:
    total = F.col(total) if isinstance(total, str) else total
    return total.cast("double") / F.lit(float(UNITS))


def grand_total(amounts: Column | str) -> Column:
    """Sum of whole units over many customers: wider than BIGINT."""
    amounts = F.col(amounts) if isinstance(amounts, str) else amounts
    return F.sum(amounts.cast("decimal(20,0)"))


def fine(value: Column | str) -> Column:
    """A number with twelve decimals, for sums of scores that are not whole units and
    must not depend on the order of rows."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("decimal(38,12)")


def fine_sum(value: Column | str) -> Column:
    return F.sum(fine(value)).cast("double")


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole days of elapsed time, not calendar days."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("DAY", start, end).cast("int")


def round_even(value: Column, digits: int = 2) -> Column:
    """Scale, round half to even, scale back: the rounding of numeric arrays."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def timestamp_literal(moment: datetime) -> Column:
    """A constant without time zone, so that comparisons reach the Parquet reader."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(moment: Column | str) -> Column:
    return F.trunc(F.col(moment) if isinstance(moment, str) else moment, "month")


def month_index(month: Column | str) -> Column:
    month = F.col(month) if isinstance(month, str) else month
    return (F.year(month) * 12 + F.month(month)).cast("int")


def mean_gap_days(first: str, last: str, orders: str) -> Column:
    """Mean whole-day gap between orders; 0 for a single order."""
    return F.when(
        F.col(orders) > 1, elapsed_days(first, last) / (F.col(orders) - 1)
    ).otherwise(F.lit(0.0))


def null_if_nan(df: DataFrame, name: str) -> Column:
    if dict(df.dtypes)[name] in ("double", "float"):
        return F.when(~F.isnan(name), F.col(name))
    return F.col(name)


def hash_fraction_key(identity: Column | str) -> Column:
    """The first 13 hex digits of md5 as BIGINT: a stable shuffle order of ids."""
    identity = F.col(identity) if isinstance(identity, str) else identity
    digest = F.md5(identity.cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
