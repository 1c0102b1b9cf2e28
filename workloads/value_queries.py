"""Lifetime value: split, repeat-purchase summary, features, and reports on a fixed score.

The fixed score stands in for a model so that the reports can be checked against SQL:
15 % of revenue per order, which is no whole number of money units.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from patronage.operators import charts, repeat, repeat_fit, segments, value
from patronage.operators.grains import date_span
from patronage.session import stage
from workloads.registry import query
from workloads.retail import EVENT_RAW_SQL, RFM_COLUMNS, staged_clean, staged_events, with_clean
from workloads.segment_queries import RFM_CTE

SPLIT_CTE = """
span AS (SELECT MIN(InvoiceDate) AS t0, MAX(InvoiceDate) AS t1 FROM clean),
cut AS (SELECT t0 + TO_DAYS(CAST(FLOOR(DATE_SUB('day', t0, t1) * 9 / 12) AS INT)) AS split FROM span),
cal AS (SELECT clean.* FROM clean, cut WHERE InvoiceDate <= split),
hold AS (SELECT clean.* FROM clean, cut WHERE InvoiceDate > split)
"""
REPEAT_SQL = """
SELECT CustomerID, COUNT(DISTINCT InvoiceNo) - 1 AS frequency,
  DATE_SUB('day', MIN(InvoiceDate), MAX(InvoiceDate))::INT AS recency,
  DATE_SUB('day', MIN(InvoiceDate), ANY_VALUE(split))::INT AS T,
  COALESCE(SUM(u) FILTER (InvoiceDate > opened)::DOUBLE / 10000
    / NULLIF(COUNT(DISTINCT InvoiceNo) FILTER (InvoiceDate > opened), 0), 0) AS monetary_value
FROM (SELECT *, MIN(InvoiceDate) OVER (PARTITION BY CustomerID) AS opened FROM cal), cut
GROUP BY CustomerID"""
FEATURES_SQL = """
SELECT CustomerID, DATE_SUB('day', MAX(InvoiceDate), ref)::INT AS recency,
  COUNT(DISTINCT InvoiceNo) AS frequency, SUM(u)::DOUBLE / 10000 AS monetary,
  SUM(u)::DOUBLE / 10000 / COUNT(DISTINCT InvoiceNo) AS avg_order_value,
  COUNT(DISTINCT StockCode) AS unique_products, SUM(Quantity)::BIGINT AS total_quantity,
  DATE_SUB('day', MIN(InvoiceDate), ref)::INT AS tenure_days,
  CASE WHEN COUNT(DISTINCT InvoiceNo) > 1
    THEN DATE_SUB('day', MIN(InvoiceDate), MAX(InvoiceDate))::DOUBLE / (COUNT(DISTINCT InvoiceNo) - 1)
    ELSE 0.0::DOUBLE END AS avg_days_between,
  SUM(Quantity)::DOUBLE / COUNT(DISTINCT InvoiceNo) AS items_per_order,
  COALESCE((SELECT SUM(u) FROM hold h WHERE h.CustomerID = cal.CustomerID), 0)::DOUBLE / 10000
    AS holdout_revenue
FROM cal, (SELECT MAX(InvoiceDate) + INTERVAL 1 DAY AS ref FROM cal)
GROUP BY CustomerID, ref"""


def calibration(clean):
    return value.split_calibration(clean, span=date_span(clean))


def _repeat(clean):
    split = calibration(clean)
    return value.repeat_summary(split.calibration, split.split_date)


def _features(clean):
    split = calibration(clean)
    return value.clv_features(split.calibration, split.holdout)


@query(with_clean(SPLIT_CTE) + "SELECT 'calibration' AS part, COUNT(*) AS lines, ANY_VALUE(split) AS split_date "
       "FROM cal, cut UNION ALL SELECT 'holdout', COUNT(*), ANY_VALUE(split) FROM hold, cut")  # fmt: skip
def value_split(spark, sf_dir):
    split = calibration(staged_clean(spark, sf_dir, "InvoiceDate"))
    sizes = [
        part.agg(F.lit(name).alias("part"), F.count("*").alias("lines"))
        for name, part in (("calibration", split.calibration), ("holdout", split.holdout))
    ]
    return sizes[0].unionByName(sizes[1]).withColumn(
        "split_date", F.lit(split.split_date).cast("timestamp_ntz")
    )


@query(with_clean(SPLIT_CTE) + REPEAT_SQL)
def repeat_summary(spark, sf_dir):
    return _repeat(staged_clean(spark, sf_dir, "CustomerID", "InvoiceNo", "InvoiceDate", "Revenue"))


@query(with_clean(SPLIT_CTE, source=EVENT_RAW_SQL) + REPEAT_SQL)
def repeat_summary_events(spark, sf_dir):
    return _repeat(staged_events(spark, sf_dir))


@query(with_clean(SPLIT_CTE) + FEATURES_SQL)
def clv_features(spark, sf_dir):
    return _features(staged_clean(spark, sf_dir))


@query(with_clean(SPLIT_CTE, source=EVENT_RAW_SQL) + FEATURES_SQL)
def clv_features_events(spark, sf_dir):
    return _features(staged_events(spark, sf_dir))


VALUED_CTE = """
valued AS (SELECT CustomerID, Monetary / Frequency * 0.15::DOUBLE AS predicted_clv FROM rfm),
tiers AS (SELECT QUANTILE_CONT(predicted_clv, [0.4, 0.7, 0.9]) AS e FROM valued),
tiered AS (
  SELECT CustomerID, predicted_clv, CASE WHEN predicted_clv >= e[3] THEN 'Platinum'
    WHEN predicted_clv >= e[2] THEN 'Gold' WHEN predicted_clv >= e[1] THEN 'Silver'
    ELSE 'Bronze' END AS CLV_Tier
  FROM valued, tiers)
"""
FINE = "SUM(CAST({0} AS DECIMAL(38,12)))::DOUBLE"


def fixed_value(clean):
    """Customers with the fixed score."""
    rfm = segments.compute_rfm(clean)
    return rfm.select(
        "CustomerID", (F.col("Monetary") / F.col("Frequency") * F.lit(0.15)).alias("predicted_clv")
    )


def fixed_tiers(clean):
    return value.assign_tiers(fixed_value(clean))


@query(with_clean(RFM_CTE, VALUED_CTE) + "SELECT * FROM tiered")
def clv_tiers(spark, sf_dir):
    return fixed_tiers(staged_clean(spark, sf_dir, *RFM_COLUMNS))[0]


@query(with_clean(RFM_CTE, VALUED_CTE) + """
SELECT 'Platinum' AS CLV_Tier, e[3] AS lower_bound, NULL::DOUBLE AS upper_bound FROM tiers
UNION ALL SELECT 'Gold', e[2], e[3] FROM tiers UNION ALL SELECT 'Silver', e[1], e[2] FROM tiers
UNION ALL SELECT 'Bronze', NULL, e[1] FROM tiers""")  # fmt: skip
def clv_tier_bounds(spark, sf_dir):
    return fixed_tiers(staged_clean(spark, sf_dir, *RFM_COLUMNS))[1].drop("label")


@query(with_clean(RFM_CTE, VALUED_CTE) + f"""
SELECT 'H2: At current CAC, ≥30% of customers are unprofitable over 6-month horizon' AS hypothesis,
  380.0::DOUBLE AS cac_inr, ROUND_EVEN(380.0::DOUBLE / 105 * 100, 0) / 100 AS cac_gbp, unprofitable_count,
  ROUND_EVEN(share * 100, 0) / 100 AS unprofitable_pct, share >= 30 AS h2_validated,
  ROUND_EVEN(mean * 100, 0) / 100 AS mean_clv, ROUND_EVEN(middle * 100, 0) / 100 AS median_clv
FROM (SELECT COUNT(*) FILTER (predicted_clv < 380.0::DOUBLE / 105) AS unprofitable_count,
  COUNT(*) FILTER (predicted_clv < 380.0::DOUBLE / 105)::DOUBLE / COUNT(*) * 100 AS share,
  {FINE.format("predicted_clv")} / COUNT(*) AS mean, MEDIAN(predicted_clv) AS middle FROM valued)""")  # fmt: skip
def hypothesis_acquisition_cost(spark, sf_dir):
    return value.validate_h2(fixed_value(staged_clean(spark, sf_dir, *RFM_COLUMNS)))


@query(with_clean(RFM_CTE, VALUED_CTE) + f"""
SELECT *, 380.0::DOUBLE / 105 AS cac_gbp, avg_clv - 380.0::DOUBLE / 105 AS profit_per_customer,
  ROUND_EVEN(380.0::DOUBLE / 105 / NULLIF(avg_clv, 0) * 100 * 100, 0) / 100 AS cac_as_pct_of_clv,
  avg_clv - 380.0::DOUBLE / 105 > 0 AS is_profitable
FROM (SELECT CLV_Tier, COUNT(*) AS customer_count, {FINE.format("predicted_clv")} / COUNT(*) AS avg_clv,
  MEDIAN(predicted_clv) AS median_clv, {FINE.format("predicted_clv")} AS total_clv
  FROM tiered GROUP BY CLV_Tier)""")  # fmt: skip
def budget_by_tier(spark, sf_dir):
    return value.budget_by_tier(fixed_tiers(staged_clean(spark, sf_dir, *RFM_COLUMNS))[0])


@query(with_clean(RFM_CTE, VALUED_CTE) + """
SELECT CustomerID, predicted_clv,
  SUM(d) OVER w::DOUBLE / (SUM(d) OVER ())::DOUBLE * 100 AS cum_revenue_pct,
  ROW_NUMBER() OVER w / (COUNT(*) OVER ())::DOUBLE * 100 AS cum_customer_pct
FROM (SELECT *, CAST(predicted_clv AS DECIMAL(38,12)) AS d FROM valued)
WINDOW w AS (ORDER BY predicted_clv DESC, CustomerID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")  # fmt: skip
def value_concentration(spark, sf_dir):
    return segments.concentration(
        fixed_value(staged_clean(spark, sf_dir, *RFM_COLUMNS)), "predicted_clv"
    )


# ---- tables behind charts

ORDER_VALUES_CTE = """
order_values AS (SELECT InvoiceNo, SUM(u)::DOUBLE / 10000 AS value FROM clean GROUP BY InvoiceNo)
"""


def histogram_sql(source: str, column: str, by: str = "") -> str:
    own = f"{by}, " if by else ""
    return f"""
SELECT {own}bin, lo + bin * ((hi - lo) / 50) AS bin_start, COUNT(*) AS rows
FROM (SELECT {own}lo, hi,
    LEAST(COALESCE(FLOOR(({column} - lo) / NULLIF((hi - lo) / 50, 0)), 0), 49)::INT AS bin
  FROM {source}, (SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {source}))
GROUP BY {own}bin, lo, hi"""


@query(with_clean() + """
SELECT LEAST(n, 20) AS orders, COUNT(*) AS customers
FROM (SELECT COUNT(DISTINCT InvoiceNo) AS n FROM clean GROUP BY CustomerID) GROUP BY ALL""")  # fmt: skip
def order_histogram(spark, sf_dir):
    from patronage.operators.profile import orders_per_customer
    from workloads.retail import clean_lines

    return charts.order_histogram(orders_per_customer(clean_lines(spark, sf_dir)))


def _order_values(spark, sf_dir):
    from patronage.functions.columns import from_units
    from patronage.operators.profile import order_values

    clean = staged_clean(spark, sf_dir, "InvoiceNo", "Quantity", "Revenue")
    return order_values(clean).select(from_units("amount").alias("value"))


@query(with_clean(ORDER_VALUES_CTE) + histogram_sql("order_values", "value"))
def order_value_histogram(spark, sf_dir):
    return charts.histogram(_order_values(spark, sf_dir))


@query(with_clean(ORDER_VALUES_CTE) + "SELECT QUANTILE_CONT(value, 0.95) AS value FROM order_values")
def order_value_axis(spark, sf_dir):
    return charts.upper_quantile(_order_values(spark, sf_dir))


@query(with_clean(RFM_CTE, VALUED_CTE) + histogram_sql("tiered", "predicted_clv", "CLV_Tier"))
def value_histogram_by_tier(spark, sf_dir):
    tiered = fixed_tiers(staged_clean(spark, sf_dir, *RFM_COLUMNS))[0]
    return charts.histogram(tiered.withColumnRenamed("predicted_clv", "value"), ["CLV_Tier"])


@query(with_clean(RFM_CTE, VALUED_CTE) + """,
q AS (SELECT CLV_Tier, COUNT(*) AS rows, QUANTILE_CONT(predicted_clv, [0.25, 0.5, 0.75]) AS e
  FROM tiered GROUP BY CLV_Tier)
SELECT CLV_Tier, rows, e[1] AS q1, e[2] AS median, e[3] AS q3,
  MIN(predicted_clv) FILTER (predicted_clv >= e[1] - 1.5::DOUBLE * (e[3] - e[1])) AS low,
  MAX(predicted_clv) FILTER (predicted_clv <= e[3] + 1.5::DOUBLE * (e[3] - e[1])) AS high
FROM tiered JOIN q USING (CLV_Tier) GROUP BY CLV_Tier, rows, e""")  # fmt: skip
def value_boxes_by_tier(spark, sf_dir):
    tiered = fixed_tiers(staged_clean(spark, sf_dir, *RFM_COLUMNS))[0]
    return charts.box_statistics(tiered.withColumnRenamed("predicted_clv", "value"), "CLV_Tier")


# ---- probability models

FIXED_PURCHASES = repeat.PurchaseModel(r=0.8, alpha=60.0, a=1.4, b=2.5)
FIXED_SPEND = repeat.SpendModel(p=6.0, q=4.0, v=15.0)
REPEAT_CTE = "rep AS (" + REPEAT_SQL + ")"


@query(with_clean(SPLIT_CTE, REPEAT_CTE) + """
SELECT CustomerID, CASE WHEN frequency > 0 THEN 1 / (1 + 1.4::DOUBLE / (2.5::DOUBLE + frequency - 1)
    * POW((60.0::DOUBLE + T) / (60.0::DOUBLE + recency), 0.8::DOUBLE + frequency)) ELSE 1 END AS prob_alive,
  CASE WHEN frequency > 0 AND monetary_value > 0 THEN
    6.0::DOUBLE * frequency / (6.0::DOUBLE * frequency + 3.0::DOUBLE) * monetary_value
    + (1 - 6.0::DOUBLE * frequency / (6.0::DOUBLE * frequency + 3.0::DOUBLE)) * 30.0::DOUBLE
  ELSE (SELECT AVG(monetary_value) FROM rep WHERE frequency > 0 AND monetary_value > 0) END AS expected_avg_profit
FROM rep""")  # fmt: skip
def value_model_fixed(spark, sf_dir):
    summary = _repeat(staged_clean(spark, sf_dir, "CustomerID", "InvoiceNo", "InvoiceDate", "Revenue"))
    scored = repeat.predict_value(summary, FIXED_PURCHASES, FIXED_SPEND)
    return scored.select("CustomerID", "prob_alive", "expected_avg_profit")


@query()
def value_model_predictions(spark, sf_dir):
    """All that the models give; the series of the purchases cannot be said in SQL."""
    summary = _repeat(staged_clean(spark, sf_dir, "CustomerID", "InvoiceNo", "InvoiceDate", "Revenue"))
    scored = repeat.predict_value(summary, FIXED_PURCHASES, FIXED_SPEND)
    return scored.select("CustomerID", "expected_purchases", "prob_alive", "expected_avg_profit", "predicted_clv")


# ---- fitted models


def _summary(spark, sf_dir):
    return _repeat(staged_clean(spark, sf_dir, "CustomerID", "InvoiceNo", "InvoiceDate", "Revenue"))


@query()
def purchase_model_fit(spark, sf_dir):
    """Parameters of the purchase model; an iteration, not to be said in SQL."""
    return repeat_fit.fit_table(spark, repeat_fit.fit_purchases(_summary(spark, sf_dir)))


@query()
def spend_model_fit(spark, sf_dir):
    return repeat_fit.fit_table(spark, repeat_fit.fit_spend(_summary(spark, sf_dir)))


@query()
def value_model_fitted(spark, sf_dir):
    """Values of all customers from the models fitted on the same table."""
    summary = stage(_summary(spark, sf_dir), "repeat_summary")
    purchases, spend = repeat_fit.fit_purchases(summary), repeat_fit.fit_spend(summary)
    scored = repeat.predict_value(summary, purchases.model, spend.model)
    return scored.select("CustomerID", "expected_purchases", "prob_alive", "expected_avg_profit", "predicted_clv")
