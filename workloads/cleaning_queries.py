"""Cleaning, returns, customer table, cohorts and revenue profile."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from patronage.operators import cleaning, profile
from workloads.registry import query
from workloads.retail import (
    EVENT_RAW_SQL,
    ONE_COUNTRY,
    PARAMS,
    RAW_SQL,
    RFM_COLUMNS,
    clean_lines,
    event_lines,
    raw_lines,
    staged_clean,
    staged_events,
    with_clean,
)

CLEAN_COLUMNS = (
    "InvoiceNo, StockCode, Quantity, InvoiceDate, UnitPrice, CustomerID, Country, "
    "is_cancellation, Revenue"
)


def report_sql(country: str | None) -> str:
    scope = f"Country = '{country}'" if country else "TRUE"
    other = (
        f"COUNT(*) FILTER (known AND NOT cancelled AND Quantity > 0 AND UnitPrice > 0 "
        f"AND Country IS DISTINCT FROM '{country}') AS non_uk_rows_removed,"
        if country
        else ""
    )
    return with_clean(
        """
marked AS (SELECT *, CustomerID IS NOT NULL AS known, InvoiceNo LIKE 'C%' AS cancelled FROM raw)
""",
        f"""
steps AS (
  SELECT COUNT(*) AS raw_rows, COUNT(*) FILTER (InvoiceNo IS NULL) AS null_invoice_rows,
    COUNT(*) FILTER (InvoiceDate IS NULL) AS undated_rows,
    COUNT(*) FILTER (NOT known) AS null_customer_ids_dropped,
    COUNT(*) FILTER (known AND cancelled) AS cancellation_rows,
    COUNT(*) FILTER (known AND NOT cancelled AND Quantity <= 0) AS negative_quantity_removed,
    COUNT(*) FILTER (known AND NOT cancelled AND Quantity > 0 AND UnitPrice <= 0)
      AS negative_price_removed,
    {other}
    COUNT(*) FILTER (known AND NOT cancelled AND Quantity > 48 AND UnitPrice > 0 AND {scope})
      AS quantity_outliers_removed,
    COUNT(*) FILTER (known AND NOT cancelled AND Quantity > 0 AND UnitPrice > 10000 AND {scope})
      AS price_outliers_removed,
    COUNT(*) FILTER (known AND NOT cancelled AND Quantity > 0 AND Quantity <= 48
      AND UnitPrice > 0 AND UnitPrice <= 10000 AND {scope}) AS before_duplicates
  FROM marked)
""",
        country=country,
    ) + """
SELECT steps.* EXCLUDE (before_duplicates),
  before_duplicates - clean_rows AS duplicates_removed, clean_rows, unique_customers,
  date_start, date_end
FROM steps, (SELECT COUNT(*) AS clean_rows, COUNT(DISTINCT CustomerID) AS unique_customers,
  MIN(InvoiceDate)::DATE AS date_start, MAX(InvoiceDate)::DATE AS date_end FROM clean)"""


@query("WITH " + RAW_SQL + " SELECT * FROM raw")
def raw_transactions(spark, sf_dir):
    return cleaning.normalise(raw_lines(spark, sf_dir))


@query(with_clean() + f" SELECT {CLEAN_COLUMNS} FROM clean")
def clean_transactions(spark, sf_dir):
    return clean_lines(spark, sf_dir)


@query(with_clean(country="NATION_3") + f" SELECT {CLEAN_COLUMNS} FROM clean")
def clean_transactions_one_country(spark, sf_dir):
    return clean_lines(spark, sf_dir, ONE_COUNTRY)


@query(with_clean(source=EVENT_RAW_SQL) + f" SELECT {CLEAN_COLUMNS} FROM clean")
def clean_events(spark, sf_dir):
    return cleaning.clean_transactions(event_lines(spark, sf_dir), PARAMS)


@query(report_sql(None))
def cleaning_report(spark, sf_dir):
    return cleaning.cleaning_report(raw_lines(spark, sf_dir), PARAMS)


@query(report_sql("NATION_3"))
def cleaning_report_one_country(spark, sf_dir):
    return cleaning.cleaning_report(raw_lines(spark, sf_dir), ONE_COUNTRY)


RETURNS_SQL = """
SELECT CustomerID,
  COALESCE(CAST({cancelled} AS DOUBLE) / NULLIF(COUNT(DISTINCT InvoiceNo), 0), 0) AS return_rate,
  {cancelled} AS cancelled_orders
FROM raw WHERE CustomerID IS NOT NULL {extra} GROUP BY CustomerID"""


@query(
    "WITH "
    + RAW_SQL
    + RETURNS_SQL.format(cancelled="COUNT(*) FILTER (InvoiceNo LIKE 'C%')", extra="")
)
def customer_returns(spark, sf_dir):
    return cleaning.customer_returns(raw_lines(spark, sf_dir), country=None)


@query(
    "WITH "
    + RAW_SQL
    + RETURNS_SQL.format(
        cancelled="COUNT(DISTINCT InvoiceNo) FILTER (InvoiceNo LIKE 'C%')",
        extra="AND Country = 'NATION_3' AND InvoiceDate <= TIMESTAMP '1999-06-30'",
    )
)
def customer_returns_by_invoice(spark, sf_dir):
    return cleaning.customer_returns(
        raw_lines(spark, sf_dir), "NATION_3", mode="invoices", as_of=datetime(1999, 6, 30)
    )


@query(
    with_clean()
    + f""" SELECT {CLEAN_COLUMNS} FROM clean
WHERE InvoiceDate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'"""
)
def clean_date_range(spark, sf_dir):
    return cleaning.between_dates(
        clean_lines(spark, sf_dir), datetime(1997, 1, 1), datetime(1998, 12, 31)
    )


CUSTOMER_TABLE_SQL = """
SELECT CustomerID, MIN(InvoiceDate) AS first_purchase, MAX(InvoiceDate) AS last_purchase,
  COUNT(DISTINCT InvoiceNo) AS frequency, SUM(u)::DOUBLE / 10000 AS total_revenue,
  SUM(Quantity)::BIGINT AS total_quantity, COUNT(DISTINCT StockCode) AS unique_products,
  SUM(u)::DOUBLE / 10000 / COUNT(DISTINCT InvoiceNo) AS avg_order_value,
  DATE_SUB('day', MAX(InvoiceDate), ref)::INT AS recency_days,
  DATE_SUB('day', MIN(InvoiceDate), ref)::INT AS tenure_days,
  CASE WHEN COUNT(DISTINCT InvoiceNo) > 1
    THEN DATE_SUB('day', MIN(InvoiceDate), MAX(InvoiceDate))::DOUBLE
         / (COUNT(DISTINCT InvoiceNo) - 1)
    ELSE 0.0::DOUBLE END AS avg_days_between_purchases,
  ref AS reference_date
FROM clean, (SELECT MAX(InvoiceDate) + INTERVAL 1 DAY AS ref FROM clean)
GROUP BY CustomerID, ref"""


@query(with_clean() + CUSTOMER_TABLE_SQL)
def customer_table(spark, sf_dir):
    return profile.customer_table(staged_clean(spark, sf_dir, *RFM_COLUMNS, "StockCode"))


@query(with_clean(source=EVENT_RAW_SQL) + CUSTOMER_TABLE_SQL)
def customer_table_events(spark, sf_dir):
    return profile.customer_table(staged_events(spark, sf_dir))


MONTHS_SQL = """
months AS (
  SELECT CustomerID, month, MIN(month) OVER (PARTITION BY CustomerID) AS first_month
  FROM (SELECT DISTINCT CustomerID, DATE_TRUNC('month', InvoiceDate)::DATE AS month FROM clean))
"""
RETENTION_SQL = """
sizes AS (
  SELECT first_month AS cohort_month,
    CAST(DATE_DIFF('month', first_month, month) AS INT) AS period_index, COUNT(*) AS customers
  FROM months GROUP BY ALL),
retention AS (
  SELECT *, customers / MAX(CASE WHEN period_index = 0 THEN customers END)
    OVER (PARTITION BY cohort_month) * 100 AS retention_pct
  FROM sizes)
"""


@query(with_clean(MONTHS_SQL, RETENTION_SQL) + "SELECT * FROM retention")
def cohort_retention(spark, sf_dir):
    return profile.cohort_retention(clean_lines(spark, sf_dir))


# The clean lines span 79 months, so the SQL lists periods 0 to 78; the operator takes the
# width from the data.
@query(
    with_clean(MONTHS_SQL, RETENTION_SQL)
    + "SELECT cohort_month, "
    + ", ".join(
        f'MAX(retention_pct) FILTER (period_index = {i}) AS "{i}"' for i in range(79)
    )
    + " FROM retention GROUP BY cohort_month"
)
def cohort_matrix(spark, sf_dir):
    return profile.cohort_matrix(profile.cohort_retention(clean_lines(spark, sf_dir)))


@query(
    with_clean(
        """
values_per_order AS (SELECT InvoiceNo, SUM(u)::DOUBLE AS amount, SUM(Quantity)::DOUBLE AS quantity
  FROM clean GROUP BY InvoiceNo)
"""
    )
    + """
SELECT total_customers, total_transactions, total_revenue,
  avg_order_value, median_order_value, total_revenue / total_customers AS avg_revenue_per_customer,
  date_range_start, date_range_end, total_products, avg_items_per_order
FROM (SELECT COUNT(DISTINCT CustomerID) AS total_customers, SUM(u)::DOUBLE / 10000 AS total_revenue,
        MIN(InvoiceDate) AS date_range_start, MAX(InvoiceDate) AS date_range_end,
        COUNT(DISTINCT StockCode) AS total_products FROM clean),
     (SELECT COUNT(*) AS total_transactions, SUM(amount) / 10000 / COUNT(*) AS avg_order_value,
        QUANTILE_CONT(amount / 10000, 0.5) AS median_order_value,
        AVG(quantity) AS avg_items_per_order FROM values_per_order)"""
)
def revenue_profile(spark, sf_dir):
    return profile.revenue_profile(staged_clean(spark, sf_dir))


@query(
    with_clean(
        """
by_month AS (SELECT DATE_TRUNC('month', InvoiceDate)::DATE AS m, SUM(u)::DOUBLE / 10000 AS revenue
  FROM clean GROUP BY 1),
spine AS (SELECT UNNEST(GENERATE_SERIES(MIN(m)::TIMESTAMP, MAX(m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE
  AS m FROM by_month)
"""
    )
    + """ SELECT LAST_DAY(spine.m) AS month, COALESCE(revenue, 0) AS revenue
FROM spine LEFT JOIN by_month USING (m)"""
)
def monthly_revenue(spark, sf_dir):
    return profile.monthly_revenue(clean_lines(spark, sf_dir))


@query(
    with_clean()
    + "SELECT CustomerID, COUNT(DISTINCT InvoiceNo) AS order_count FROM clean GROUP BY CustomerID"
)
def orders_per_customer(spark, sf_dir):
    return profile.orders_per_customer(clean_lines(spark, sf_dir))


@query(
    with_clean()
    + """SELECT DAYNAME(InvoiceDate) AS day_of_week, SUM(u)::DOUBLE / 10000 AS revenue
FROM clean GROUP BY 1"""
)
def weekday_revenue(spark, sf_dir):
    return profile.weekday_revenue(clean_lines(spark, sf_dir))


@query(
    with_clean(MONTHS_SQL)
    + """SELECT month, COUNT(*) FILTER (month <> first_month) AS returning,
  COUNT(*) FILTER (month = first_month) AS new FROM months GROUP BY month"""
)
def new_and_returning(spark, sf_dir):
    return profile.new_and_returning(clean_lines(spark, sf_dir))
