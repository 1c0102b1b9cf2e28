"""Customer table, cohort retention and revenue profile."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.columns import (
    elapsed_days,
    from_units,
    grand_total,
    mean_gap_days,
    month_index,
    month_start,
    timestamp_literal,
    units,
)
from patronage.operators.grains import (
    customer_months,
    date_span,
    orders,
    products_per_customer,
)
from patronage.operators.ranking import quantiles
from patronage.session import stage

ONE_DAY = timedelta(days=1)


def reference_date_of(clean: DataFrame) -> datetime:
    return date_span(clean)[1] + ONE_DAY


def customer_table(clean: DataFrame, reference_date: datetime | None = None) -> DataFrame:
    """One row per customer. Orders and products are counted on separate distinct
    grains and meet at customer grain, already partitioned by customer."""
    reference = timestamp_literal(reference_date or reference_date_of(clean))
    per_customer = (
        orders(clean)
        .groupBy("CustomerID")
        .agg(
            F.min("first_line").alias("first_purchase"),
            F.max("last_line").alias("last_purchase"),
            F.count("InvoiceNo").alias("frequency"),
            F.sum("amount").alias("amount"),
            F.sum("quantity").alias("total_quantity"),
        )
    )
    joined = per_customer.join(products_per_customer(clean), "CustomerID", "left")
    return joined.select(
        "CustomerID",
        "first_purchase",
        "last_purchase",
        "frequency",
        from_units("amount").alias("total_revenue"),
        "total_quantity",
        F.coalesce("products", F.lit(0)).alias("unique_products"),
        F.try_divide(from_units("amount"), "frequency").alias("avg_order_value"),
        elapsed_days(F.col("last_purchase"), reference).alias("recency_days"),
        elapsed_days(F.col("first_purchase"), reference).alias("tenure_days"),
        mean_gap_days("first_purchase", "last_purchase", "frequency").alias(
            "avg_days_between_purchases"
        ),
        reference.alias("reference_date"),
    )


def cohort_retention(clean: DataFrame) -> DataFrame:
    """Customers active per cohort (month of first purchase) and month since then."""
    cohort = Window.partitionBy("CustomerID")
    sizes = (
        customer_months(clean)
        .withColumn("cohort_month", F.min("month").over(cohort))
        .groupBy(
            "cohort_month",
            (month_index("month") - month_index("cohort_month")).alias("period_index"),
        )
        .agg(F.count("*").alias("customers"))
    )
    size = F.max(F.when(F.col("period_index") == 0, F.col("customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return sizes.withColumn("retention_pct", F.col("customers") / size * 100)


def cohort_matrix(retention: DataFrame) -> DataFrame:
    """Wide form: one column per period that the data spans, null where a cohort has no
    such period."""
    last = retention.agg(F.max("period_index")).first()[0]
    periods = 0 if last is None else last + 1
    return (
        retention.groupBy("cohort_month")
        .pivot("period_index", list(range(periods)))
        .agg(F.first("retention_pct"))
        .orderBy("cohort_month")
    )


def order_values(clean: DataFrame) -> DataFrame:
    """One row per invoice, whoever placed it."""
    return (
        clean.where(F.col("InvoiceNo").isNotNull())
        .groupBy("InvoiceNo")
        .agg(F.sum(units("Revenue")).alias("amount"), F.sum("Quantity").alias("quantity"))
    )


def revenue_profile(clean: DataFrame) -> DataFrame:
    """One row of headline numbers; the median is exact. Customers, products and orders
    are counted in groupings of their own, each of one or two columns, rather than as
    distinct counts beside sums, which would multiply every line. ``clean`` is read four
    times: stage it first."""
    whole = clean.agg(
        grand_total(units("Revenue")).alias("amount"),
        F.min("InvoiceDate").alias("date_range_start"),
        F.max("InvoiceDate").alias("date_range_end"),
    )
    customers = (
        clean.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(F.sum(units("Revenue")).alias("amount"))
        .agg(F.count("*").alias("total_customers"), grand_total("amount").alias("known_amount"))
    )
    products = clean.where(F.col("StockCode").isNotNull()).select("StockCode").distinct()
    products = products.agg(F.count("*").alias("total_products"))
    values = stage(order_values(clean), "order_values")
    per_order = values.agg(
        F.count("*").alias("total_transactions"),
        (from_units(grand_total("amount")) / F.count("*")).alias("avg_order_value"),
        F.avg("quantity").alias("avg_items_per_order"),
    )
    median = quantiles(values.select(from_units("amount").alias("value")), [0.5])
    return (
        whole.crossJoin(F.broadcast(customers))  # one row each
        .crossJoin(F.broadcast(products))
        .crossJoin(F.broadcast(per_order))
        .crossJoin(F.broadcast(median))
        .select(
            "total_customers",
            "total_transactions",
            from_units("amount").alias("total_revenue"),
            "avg_order_value",
            F.col("q0").alias("median_order_value"),
            (from_units("known_amount") / F.col("total_customers")).alias(
                "avg_revenue_per_customer"
            ),
            "date_range_start",
            "date_range_end",
            "total_products",
            "avg_items_per_order",
        )
    )


def monthly_revenue(clean: DataFrame) -> DataFrame:
    """Revenue per calendar month, labelled by its last day; empty months are 0."""
    by_month = (
        clean.where(F.col("InvoiceDate").isNotNull())
        .groupBy(month_start("InvoiceDate").alias("month"))
        .agg(grand_total(units("Revenue")).alias("amount"))
    )
    spine = by_month.agg(
        F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month")).alias("spine")
    ).select(F.explode("spine").alias("month"))
    return (
        spine.join(by_month, "month", "left")
        .select(
            F.last_day("month").alias("month"),
            from_units(F.coalesce("amount", F.lit(0))).alias("revenue"),
        )
        .orderBy("month")
    )


def orders_per_customer(clean: DataFrame) -> DataFrame:
    return (
        clean.where(F.col("CustomerID").isNotNull() & F.col("InvoiceNo").isNotNull())
        .select("CustomerID", "InvoiceNo")
        .distinct()
        .groupBy("CustomerID")
        .agg(F.count("*").alias("order_count"))
    )


def weekday_revenue(clean: DataFrame) -> DataFrame:
    """Revenue by weekday name, Monday first; weekdays without sales are absent."""
    return (
        clean.where(F.col("InvoiceDate").isNotNull())
        .groupBy(
            F.weekday("InvoiceDate").alias("day_index"),
            F.date_format("InvoiceDate", "EEEE").alias("day_of_week"),
        )
        .agg(grand_total(units("Revenue")).alias("amount"))
        .orderBy("day_index")
        .select("day_of_week", from_units("amount").alias("revenue"))
    )


def new_and_returning(clean: DataFrame) -> DataFrame:
    """Customers per month in their first month, and in a later one."""
    first = F.min("month").over(Window.partitionBy("CustomerID"))
    return (
        customer_months(clean)
        .withColumn("is_new", F.col("month") == first)
        .groupBy("month")
        .agg(
            F.count_if(~F.col("is_new")).alias("returning"),
            F.count_if("is_new").alias("new"),
        )
        .orderBy("month")
    )
