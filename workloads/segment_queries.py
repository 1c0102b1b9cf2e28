"""Scores, segments and concentration."""

from __future__ import annotations

from pyspark.sql import functions as F

from patronage.operators import charts, segments
from patronage.operators.profile import orders_per_customer
from workloads.registry import query
from workloads.retail import (
    EVENT_RAW_SQL,
    RFM_COLUMNS,
    clean_lines,
    staged_clean,
    staged_events,
    with_clean,
)

RFM_CTE = """
rfm AS (
  SELECT CustomerID, DATE_SUB('day', MAX(InvoiceDate), ref)::INT AS Recency,
    COUNT(DISTINCT InvoiceNo) AS Frequency, SUM(u)::DOUBLE / 10000 AS Monetary,
    ref AS reference_date
  FROM clean, (SELECT MAX(InvoiceDate) + INTERVAL 1 DAY AS ref FROM clean)
  GROUP BY CustomerID, ref)
"""
SCORED_CTE = """
edges AS (
  SELECT QUANTILE_CONT(Recency::DOUBLE, [0.25, 0.5, 0.75]) AS r,
    QUANTILE_CONT(Monetary, [0.25, 0.5, 0.75]) AS m, COUNT(*) AS n FROM rfm),
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY Frequency, CustomerID) AS rk FROM rfm, edges),
scores AS (
  SELECT CustomerID, Recency, Frequency, Monetary, reference_date,
    CASE WHEN Recency <= r[1] THEN 4 WHEN Recency <= r[2] THEN 3
         WHEN Recency <= r[3] THEN 2 ELSE 1 END::INT AS R_Score,
    GREATEST(1, (4 * (rk - 1) + n - 2) // (n - 1))::INT AS F_Score,
    CASE WHEN Monetary <= m[1] THEN 1 WHEN Monetary <= m[2] THEN 2
         WHEN Monetary <= m[3] THEN 3 ELSE 4 END::INT AS M_Score
  FROM ranked),
segmented AS (
  SELECT *, CONCAT(R_Score, F_Score, M_Score) AS RFM_Score,
    (R_Score + F_Score + M_Score)::INT AS RFM_Agg_Score,
    CASE WHEN R_Score = 1 AND F_Score = 1 AND M_Score = 1 THEN 'Lost'
      WHEN R_Score >= 3 AND F_Score >= 3 AND M_Score >= 3
        THEN CASE WHEN R_Score + F_Score + M_Score = 12 THEN 'Champions' ELSE 'Loyal Customers' END
      WHEN R_Score >= 3 AND F_Score <= 2 THEN 'Potential Loyalists'
      WHEN R_Score <= 2 AND F_Score >= 3 AND M_Score >= 3 THEN 'At Risk'
      WHEN R_Score <= 2 AND F_Score <= 2 AND M_Score <= 2 THEN 'Hibernating'
      WHEN R_Score <= 2 AND F_Score >= 3 AND M_Score <= 2 THEN 'Need Attention'
      WHEN R_Score >= 3 AND F_Score >= 3 AND M_Score <= 2 THEN 'Promising'
      WHEN R_Score <= 2 AND F_Score <= 2 AND M_Score >= 3 THEN 'Big Spenders (Lapsed)'
      ELSE 'Others' END AS Segment
  FROM scores)
"""
MONEY = "SUM(CAST(ROUND_EVEN({0} * 10000, 0) AS BIGINT))::DOUBLE / 10000"


@query(with_clean(RFM_CTE) + "SELECT * FROM rfm")
def rfm_values(spark, sf_dir):
    return segments.compute_rfm(staged_clean(spark, sf_dir, *RFM_COLUMNS))


@query(with_clean(RFM_CTE, source=EVENT_RAW_SQL) + "SELECT * FROM rfm")
def rfm_values_events(spark, sf_dir):
    return segments.compute_rfm(staged_events(spark, sf_dir))


@query(with_clean(RFM_CTE, SCORED_CTE) + "SELECT * FROM segmented")
def rfm_scored(spark, sf_dir):
    return segments.segment_customers(staged_clean(spark, sf_dir, *RFM_COLUMNS))


@query(with_clean(RFM_CTE, SCORED_CTE, source=EVENT_RAW_SQL) + "SELECT * FROM segmented")
def rfm_scored_events(spark, sf_dir):
    return segments.segment_customers(staged_events(spark, sf_dir))


SUMMARY_CTE = f"""
grouped AS (
  SELECT Segment, COUNT(*) AS customer_count, AVG(Recency) AS avg_recency,
    AVG(Frequency) AS avg_frequency, {MONEY.format("Monetary")} AS total_revenue,
    MEDIAN(Monetary) AS median_monetary
  FROM segmented GROUP BY Segment),
summary AS (
  SELECT Segment, customer_count, avg_recency, avg_frequency,
    total_revenue / customer_count AS avg_monetary, total_revenue, median_monetary,
    ROUND_EVEN(customer_count / (SUM(customer_count) OVER ())::DOUBLE * 100 * 100, 0) / 100
      AS pct_customers,
    ROUND_EVEN(total_revenue / (SELECT {MONEY.format("Monetary")} FROM segmented) * 100 * 100, 0)
      / 100 AS pct_revenue
  FROM grouped)
"""


@query(with_clean(RFM_CTE, SCORED_CTE, SUMMARY_CTE) + "SELECT * FROM summary")
def segment_summary(spark, sf_dir):
    return segments.segment_summary(segments.segment_customers(staged_clean(spark, sf_dir, *RFM_COLUMNS)))


@query(
    with_clean(RFM_CTE, SCORED_CTE, SUMMARY_CTE)
    + " UNION ALL ".join(
        f"SELECT Segment, '{m}' AS metric, {m} AS value FROM summary"
        for m in ("avg_recency", "avg_frequency", "avg_monetary")
    )
)
def segment_averages(spark, sf_dir):
    return charts.segment_averages(
        segments.segment_summary(segments.segment_customers(staged_clean(spark, sf_dir, *RFM_COLUMNS)))
    )


def _campaign_sql() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    rows = ", ".join(
        f"({quoted(name)}, {quoted(strategy)}, {quoted(' | '.join(actions))}, {quoted(channel)}, "
        f"{quoted(discount)})"
        for name, (strategy, actions, channel, discount) in segments.CAMPAIGNS.items()
    )
    return f"campaign(Segment, strategy, actions, channel, discount) AS (VALUES {rows})"


@query(
    with_clean(RFM_CTE, SCORED_CTE, _campaign_sql())
    + """SELECT CustomerID, Segment, strategy, actions, channel, discount
FROM segmented JOIN campaign USING (Segment)"""
)
def customer_campaigns(spark, sf_dir):
    customers = segments.segment_customers(staged_clean(spark, sf_dir, *RFM_COLUMNS))
    return segments.with_campaign(customers.select("CustomerID", "Segment")).withColumn(
        "actions", F.array_join("actions", " | ")
    )


H1_SQL = f"""
SELECT 'H1: Top 20% by RFM score contribute >60% of total revenue' AS hypothesis,
  ROUND_EVEN(share * 100, 0) / 100 AS top_20_revenue_pct, top_20_customer_count,
  share > 60 AS h1_revenue_validated, at_risk_count,
  ROUND_EVEN(risk * 100, 0) / 100 AS at_risk_pct, risk >= 10 AS h1_at_risk_validated
FROM (
  SELECT SUM(CASE WHEN RFM_Agg_Score >= cut THEN u END)::DOUBLE / 10000
      / (SUM(u)::DOUBLE / 10000) * 100 AS share,
    COUNT(*) FILTER (RFM_Agg_Score >= cut) AS top_20_customer_count,
    COUNT(*) FILTER (Segment = 'At Risk') AS at_risk_count,
    COUNT(*) FILTER (Segment = 'At Risk') / COUNT(*)::DOUBLE * 100 AS risk
  FROM (SELECT *, CAST(ROUND_EVEN(Monetary * 10000, 0) AS BIGINT) AS u FROM segmented),
       (SELECT QUANTILE_CONT(RFM_Agg_Score::DOUBLE, 0.8) AS cut FROM segmented))"""


@query(with_clean(RFM_CTE, SCORED_CTE) + H1_SQL)
def hypothesis_revenue_share(spark, sf_dir):
    return segments.validate_h1(segments.segment_customers(staged_clean(spark, sf_dir, *RFM_COLUMNS)))


@query(
    with_clean(RFM_CTE)
    + """
SELECT CustomerID, Monetary,
  SUM(u) OVER w::DOUBLE / 10000 / (SUM(u) OVER ()::DOUBLE / 10000) * 100 AS cum_revenue_pct,
  ROW_NUMBER() OVER w / (COUNT(*) OVER ())::DOUBLE * 100 AS cum_customer_pct
FROM (SELECT *, CAST(ROUND_EVEN(Monetary * 10000, 0) AS BIGINT) AS u FROM rfm)
WINDOW w AS (ORDER BY Monetary DESC, CustomerID
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
)
def pareto_analysis(spark, sf_dir):
    return segments.concentration(segments.compute_rfm(staged_clean(spark, sf_dir, *RFM_COLUMNS)))


@query(
    with_clean(RFM_CTE, SCORED_CTE)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS metric, CAST({c} AS VARCHAR) AS value, COUNT(*) AS customers "
        "FROM segmented GROUP BY ALL"
        for c in ("R_Score", "F_Score", "M_Score", "Segment")
    )
)
def score_counts(spark, sf_dir):
    return segments.value_counts(
        segments.segment_customers(staged_clean(spark, sf_dir, *RFM_COLUMNS)),
        ["R_Score", "F_Score", "M_Score", "Segment"],
    )


def describe_sql(source: str, columns: list[str], digits: int) -> str:
    scale = 10**digits
    rounded = lambda x: f"ROUND_EVEN(({x}) * {scale}, 0) / {scale}"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS metric, COUNT({c}) AS count, {rounded(f'AVG({c}::DOUBLE)')} AS mean, "
        f"{rounded(f'STDDEV_SAMP({c}::DOUBLE)')} AS std, {rounded(f'MIN({c})::DOUBLE')} AS min, "
        + ", ".join(
            f"{rounded(f'QUANTILE_CONT({c}::DOUBLE, {q})')} AS p{int(q * 100)}"
            for q in (0.25, 0.5, 0.75)
        )
        + f", {rounded(f'MAX({c})::DOUBLE')} AS max FROM {source}"
        for c in columns
    )


@query(with_clean(RFM_CTE) + describe_sql("rfm", ["Recency", "Frequency", "Monetary"], 2))
def rfm_describe(spark, sf_dir):
    rfm = segments.compute_rfm(staged_clean(spark, sf_dir, *RFM_COLUMNS))
    return segments.describe(rfm, ["Recency", "Frequency", "Monetary"], digits=2)


@query(
    with_clean()
    + """SELECT 'order_count' AS metric, CAST(order_count AS VARCHAR) AS value,
  COUNT(*) AS customers
FROM (SELECT CustomerID, COUNT(DISTINCT InvoiceNo) AS order_count FROM clean GROUP BY CustomerID)
GROUP BY order_count"""
)
def order_count_frequencies(spark, sf_dir):
    return segments.value_counts(
        orders_per_customer(clean_lines(spark, sf_dir)), ["order_count"]
    )
