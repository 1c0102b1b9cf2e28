"""The retail line table over the given star-schema tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.operators.cleaning import clean_transactions
from patronage.params import Params
from patronage.session import stage

# The view's prices are far above the default limits, and it has many countries.
PARAMS = Params(country=None, max_quantity=48, max_unit_price=10_000)
ONE_COUNTRY = Params(country="NATION_3", max_quantity=48, max_unit_price=10_000)

# What scores and values read of the clean lines.
RFM_COLUMNS = ("CustomerID", "InvoiceNo", "InvoiceDate", "Quantity", "Revenue")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    returned = F.col("l_returnflag") == "R"
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.concat(
                F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")
            ).alias("InvoiceNo"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.when(returned, -F.col("l_quantity"))
            .otherwise(F.col("l_quantity"))
            .cast("int")
            .alias("Quantity"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("InvoiceDate"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias(
                "CustomerID"
            ),
            F.col("n_name").alias("Country"),
        )
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the event log as sales lines: timestamps with a time of day."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").cast("string").alias("InvoiceNo"),
            F.col("props").alias("StockCode"),
            F.lit(1).alias("Quantity"),
            F.col("ts").cast("timestamp_ntz").alias("InvoiceDate"),
            F.col("value").alias("UnitPrice"),
            F.col("user_id").alias("CustomerID"),
            F.lit("EVENTS").alias("Country"),
        )
    )


def clean_lines(spark: SparkSession, sf_dir: str, params: Params = PARAMS) -> DataFrame:
    return clean_transactions(raw_lines(spark, sf_dir), params)


def staged_clean(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Clean lines written once, for queries that make several passes."""
    clean = clean_lines(spark, sf_dir)
    return stage(clean.select(*columns) if columns else clean, "clean")


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(clean_transactions(event_lines(spark, sf_dir), PARAMS), "event_clean")


RAW_SQL = """
raw AS (
  SELECT CONCAT(CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END,
                CAST(l_orderkey AS VARCHAR)) AS InvoiceNo,
         CAST(l_partkey AS VARCHAR) AS StockCode,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS Quantity,
         o_orderdate AS InvoiceDate,
         l_extendedprice / l_quantity AS UnitPrice,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_custkey END AS CustomerID,
         n_name AS Country
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

EVENT_RAW_SQL = """
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS InvoiceNo, props AS StockCode, 1 AS Quantity,
         ts AS InvoiceDate, value AS UnitPrice, user_id AS CustomerID, 'EVENTS' AS Country
  FROM events WHERE event_type = 'purchase'
)"""


def clean_sql(country: str | None = None) -> str:
    only = f"AND Country = '{country}'" if country else ""
    return f"""
clean AS (
  SELECT DISTINCT InvoiceNo, StockCode, Quantity, InvoiceDate, UnitPrice, CustomerID, Country,
         FALSE AS is_cancellation, Quantity * UnitPrice AS Revenue,
         CAST(ROUND_EVEN(Quantity * UnitPrice * 10000, 0) AS BIGINT) AS u
  FROM raw
  WHERE CustomerID IS NOT NULL AND InvoiceNo NOT LIKE 'C%' AND Quantity > 0 AND UnitPrice > 0
    AND Quantity <= 48 AND UnitPrice <= 10000 {only}
)"""


def with_clean(*ctes: str, source: str = RAW_SQL, country: str | None = None) -> str:
    return "WITH " + ",".join([source, clean_sql(country), *ctes])
