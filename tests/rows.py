"""Small transaction tables for the tests."""

from __future__ import annotations

from datetime import datetime

RAW = "InvoiceNo string, StockCode string, Quantity int, InvoiceDate timestamp_ntz, UnitPrice double, CustomerID bigint, Country string"
CLEAN = RAW + ", is_cancellation boolean, Revenue double"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def lines(spark, *rows):
    """Clean lines from (customer, invoice, time, revenue[, product])."""
    full = []
    for customer, invoice, when, revenue, *product in rows:
        when = at(when) if isinstance(when, str) else when
        full.append((invoice, (product or ["p"])[0], 1, when, float(revenue), customer, "X", False, float(revenue)))
    return spark.createDataFrame(full, CLEAN)
