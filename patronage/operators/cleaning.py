"""Cleaning of raw transaction lines, the removal report, and customer returns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.columns import null_if_nan, timestamp_literal
from patronage.params import Params
from patronage.sources.schema import ALIASES

# Text forms of a date that the raw exports use, besides ISO.
DATE_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")
CANCEL_MARK = "C"


def parse_timestamp(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Bad text becomes null; the row stays."""
    value = F.col(name)
    if dict(df.dtypes)[name] != "string":
        return value.cast("timestamp_ntz")
    tries = [value.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(value, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def whole_number(df: DataFrame, name: str, target: str) -> Column:
    """Whole numbers from whatever arrives, for instance the text ``12346.0``."""
    kind, value = dict(df.dtypes)[name], F.col(name)
    if kind == "string":
        return F.coalesce(value.try_cast(target), value.try_cast("double").try_cast(target))
    if kind in ("double", "float"):
        return null_if_nan(df, name).try_cast(target)
    return value.cast(target)


def normalise(raw: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Standard names and types; other columns pass through unchanged. ``formats`` are the
    text forms of dates to try after ISO."""
    raw = raw.withColumnsRenamed(ALIASES)
    if dict(raw.dtypes)["UnitPrice"] == "string":
        raw = raw.withColumn("UnitPrice", F.col("UnitPrice").try_cast("double"))
    return raw.withColumns(
        {
            "InvoiceNo": F.col("InvoiceNo").cast("string"),
            "Quantity": whole_number(raw, "Quantity", "int"),
            "InvoiceDate": parse_timestamp(raw, "InvoiceDate", formats),
            "UnitPrice": null_if_nan(raw, "UnitPrice"),
            "CustomerID": whole_number(raw, "CustomerID", "bigint"),
        }
    )


def is_cancellation(invoice: Column | str = "InvoiceNo") -> Column:
    invoice = F.col(invoice) if isinstance(invoice, str) else invoice
    return F.coalesce(invoice.startswith(CANCEL_MARK), F.lit(False))


def _kept_before_duplicates(lines: DataFrame, params: Params) -> DataFrame:
    kept = lines.where(F.col("CustomerID").isNotNull() & ~is_cancellation())
    kept = kept.where((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))
    if params.country:
        kept = kept.where(F.col("Country") == params.country)
    return kept.where(
        (F.col("Quantity") <= params.max_quantity) & (F.col("UnitPrice") <= params.max_unit_price)
    )


def clean_transactions(
    raw: DataFrame, params: Params = Params(), formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Sales lines only: known customer, no cancellation, positive amounts, one
    country (or all), no outliers, no exact duplicates; ``Revenue`` added.

    The one shuffle is the duplicate test over whole rows; copies collapse before it.
    """
    kept = _kept_before_duplicates(normalise(raw, formats), params).dropDuplicates()
    return kept.withColumns(
        {
            "is_cancellation": F.lit(False),
            "Revenue": F.col("Quantity") * F.col("UnitPrice"),
        }
    )


def cleaning_report(
    raw: DataFrame, params: Params = Params(), formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """One row: how many lines each cleaning step removed, and what is left, beside the
    lines without an invoice number and those whose date has no known form.

    Raw lines are read once: equal lines are counted, and every figure is a sum of those
    counts. Quantity and price outliers are both counted on the lines before the outlier
    step, so a line can be in both.
    """
    lines = normalise(raw, formats)
    lines = lines.groupBy(*lines.columns).agg(F.count("*").alias("_copies"))
    known = F.col("CustomerID").isNotNull()
    sale = known & ~is_cancellation()
    positive_quantity = sale & (F.col("Quantity") > 0)
    positive = positive_quantity & (F.col("UnitPrice") > 0)

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_copies"))), F.lit(0))

    counts = [
        rows(F.lit(True)).alias("raw_rows"),
        rows(F.col("InvoiceNo").isNull()).alias("null_invoice_rows"),
        rows(F.col("InvoiceDate").isNull()).alias("undated_rows"),
        rows(~known).alias("null_customer_ids_dropped"),
        rows(known & is_cancellation()).alias("cancellation_rows"),
        rows(sale & (F.col("Quantity") <= 0)).alias("negative_quantity_removed"),
        rows(positive_quantity & (F.col("UnitPrice") <= 0)).alias("negative_price_removed"),
    ]
    in_scope = positive
    if params.country:
        wanted = F.col("Country").eqNullSafe(F.lit(params.country))
        counts.append(rows(positive & ~wanted).alias("non_uk_rows_removed"))
        in_scope = positive & wanted
    small = F.col("Quantity") <= params.max_quantity
    cheap = F.col("UnitPrice") <= params.max_unit_price
    kept = in_scope & small & cheap
    counts += [
        rows(in_scope & ~small).alias("quantity_outliers_removed"),
        rows(in_scope & ~cheap).alias("price_outliers_removed"),
        F.coalesce(F.sum(F.when(kept, F.col("_copies") - 1)), F.lit(0)).alias("duplicates_removed"),
        F.count_if(kept).alias("clean_rows"),
    ]
    kept_date = F.when(kept, F.col("InvoiceDate"))
    # One group per customer keeps the distinct count out of the sums above.
    per_customer = lines.groupBy(F.when(kept, F.col("CustomerID")).alias("customer")).agg(
        *counts, F.min(kept_date).alias("first"), F.max(kept_date).alias("last")
    )
    names = per_customer.columns[1:-2]
    return per_customer.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
        F.count("customer").alias("unique_customers"),
        F.min("first").cast("date").alias("date_start"),
        F.max("last").cast("date").alias("date_end"),
    )


def clean_data(raw: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    return clean_transactions(raw, params), cleaning_report(raw, params)


def customer_returns(
    raw: DataFrame,
    country: str | None = Params.country,
    mode: str = "lines",
    as_of: datetime | None = None,
) -> DataFrame:
    """Cancelled lines over distinct invoices per customer (can exceed 1).

    ``mode="invoices"`` counts cancelled invoices instead; ``as_of`` leaves out later
    lines, so that the rate can be used as a feature without looking ahead.
    """
    lines = normalise(raw).where(F.col("CustomerID").isNotNull())
    if country:
        lines = lines.where(F.col("Country") == country)
    if as_of is not None:
        lines = lines.where(F.col("InvoiceDate") <= timestamp_literal(as_of))
    invoices = (
        lines.select("CustomerID", "InvoiceNo", is_cancellation().alias("cancelled"))
        .groupBy("CustomerID", "InvoiceNo")
        .agg(F.count_if("cancelled").alias("lines"))
    )
    cancelled = F.sum("lines") if mode == "lines" else F.count_if(F.col("lines") > 0)
    return (
        invoices.groupBy("CustomerID")
        .agg(F.count("InvoiceNo").alias("total_orders"), cancelled.alias("cancelled_orders"))
        .select(
            "CustomerID",
            F.coalesce(
                F.try_divide("cancelled_orders", "total_orders"), F.lit(0.0)
            ).alias("return_rate"),
            "cancelled_orders",
        )
    )


def between_dates(
    df: DataFrame, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Transactions of a date range, both ends included."""
    if start is not None:
        df = df.where(F.col("InvoiceDate") >= timestamp_literal(start))
    if end is not None:
        df = df.where(F.col("InvoiceDate") <= timestamp_literal(end))
    return df
