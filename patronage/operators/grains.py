"""Coarser tables that several operators start from.

Each is one hash aggregate whose partial step collapses rows before the shuffle, so one
very busy customer or invoice does not end up in one task as raw lines.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.columns import month_start, units


def date_span(df: DataFrame) -> tuple[datetime, datetime]:
    """First and last timestamp, as two values on the driver."""
    row = df.agg(F.min("InvoiceDate").alias("first"), F.max("InvoiceDate").alias("last")).first()
    if row is None or row["first"] is None:
        raise ValueError("no dated transactions")
    return row["first"], row["last"]


def orders(clean: DataFrame) -> DataFrame:
    """One row per customer and invoice. A missing invoice number is kept as a row
    for its revenue but is not counted as an order by ``count("InvoiceNo")``."""
    return (
        clean.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID", "InvoiceNo")
        .agg(
            F.sum(units("Revenue")).alias("amount"),
            F.sum("Quantity").alias("quantity"),
            F.min("InvoiceDate").alias("first_line"),
            F.max("InvoiceDate").alias("last_line"),
        )
    )


def products_per_customer(clean: DataFrame) -> DataFrame:
    return (
        clean.where(F.col("CustomerID").isNotNull() & F.col("StockCode").isNotNull())
        .select("CustomerID", "StockCode")
        .distinct()
        .groupBy("CustomerID")
        .agg(F.count("*").alias("products"))
    )


def customer_months(clean: DataFrame) -> DataFrame:
    """Distinct (customer, month) pairs: at most one row per calendar month each."""
    return (
        clean.where(F.col("CustomerID").isNotNull() & F.col("InvoiceDate").isNotNull())
        .select("CustomerID", month_start("InvoiceDate").alias("month"))
        .distinct()
    )
