"""Churn: labels and features, and metrics and impact of a fixed score.

The fixed score stands in for a model: the share of the period that has passed since the
last purchase, in whole per cents, so that many customers tie.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from patronage.operators import charts, churn, scoring
from patronage.operators.cleaning import customer_returns
from patronage.operators.grains import date_span
from workloads.registry import query
from workloads.retail import (
    EVENT_RAW_SQL,
    PARAMS,
    raw_lines,
    staged_clean,
    staged_events,
    with_clean,
)
from workloads.value_queries import histogram_sql

PERIODS_CTE = """
span AS (SELECT MIN(InvoiceDate) AS t0, MAX(InvoiceDate) AS t1 FROM clean),
ends AS (SELECT *, LEAST(feature_end + INTERVAL 90 DAY, t1) AS outcome_end FROM (
  SELECT *, t0 + TO_DAYS(CAST(FLOOR(DATE_SUB('day', t0, t1) * 9 / 12) AS INT)) AS feature_end FROM span)),
feat AS (SELECT clean.* FROM clean, ends WHERE InvoiceDate <= feature_end),
outc AS (SELECT clean.* FROM clean, ends WHERE InvoiceDate > feature_end AND InvoiceDate <= outcome_end),
labels_ AS (SELECT DISTINCT CustomerID,
  CASE WHEN CustomerID IN (SELECT CustomerID FROM outc) THEN 0 ELSE 1 END::INT AS churned FROM feat)
"""
FEATURES_CTE = """
marks AS (SELECT *, f0 + TO_DAYS(CAST(DATE_SUB('day', f0, ref) // 2 AS INT)) AS mid FROM (
  SELECT MIN(InvoiceDate) AS f0, MAX(InvoiceDate) + INTERVAL 1 DAY AS ref FROM feat)),
ords AS (SELECT CustomerID, InvoiceNo, SUM(u) AS u, MIN(InvoiceDate) AS a, MAX(InvoiceDate) AS b,
  SUM(Quantity)::BIGINT AS q FROM feat GROUP BY CustomerID, InvoiceNo),
prods AS (SELECT CustomerID, COUNT(DISTINCT StockCode) AS p FROM feat GROUP BY CustomerID),
feats AS (
  SELECT CustomerID, DATE_SUB('day', MAX(b), ref)::INT AS recency, COUNT(*) AS frequency,
    SUM(u)::DOUBLE / 10000 AS monetary, p AS unique_products_bought, SUM(q)::BIGINT AS total_quantity,
    SUM(u)::DOUBLE / 10000 / COUNT(*) AS avg_order_value,
    DATE_SUB('day', MIN(a), ref)::INT AS days_since_first_purchase,
    (COUNT(*) = 1)::INT AS is_single_purchase_customer,
    CASE WHEN COUNT(*) > 1 THEN DATE_SUB('day', MIN(a), MAX(b))::DOUBLE / (COUNT(*) - 1)
      ELSE 0.0::DOUBLE END AS avg_days_between_purchases,
    COUNT(*) FILTER (b >= ref - INTERVAL 30 DAY) AS purchases_last_30_days,
    COUNT(*) FILTER (b >= ref - INTERVAL 60 DAY) AS purchases_last_60_days,
    COUNT(*) FILTER (b > mid) - COUNT(*) FILTER (a <= mid) AS purchase_frequency_change,
    CASE WHEN COUNT(*) > 1 THEN (LAST(u ORDER BY a, InvoiceNo) - FIRST(u ORDER BY a, InvoiceNo))::DOUBLE
      / 10000 / COUNT(*) ELSE 0.0::DOUBLE END AS order_value_trend
  FROM ords JOIN prods USING (CustomerID), marks GROUP BY CustomerID, ref, p)
"""
RETURNS_CTE = """
rets AS (SELECT CustomerID, COALESCE(COUNT(*) FILTER (InvoiceNo LIKE 'C%')::DOUBLE
  / NULLIF(COUNT(DISTINCT InvoiceNo), 0), 0) AS return_rate
  FROM raw WHERE CustomerID IS NOT NULL GROUP BY CustomerID)
"""
SCORED_CTE = """
scored AS (
  SELECT CustomerID, churned AS label, ROUND_EVEN(
    recency / (SELECT MAX(days_since_first_purchase) FROM feats)::DOUBLE * 100, 0) / 100 AS score
  FROM feats JOIN labels_ USING (CustomerID))
"""
CELLS = """
  COUNT(*) FILTER (score >= {t} AND label = 1) AS tp, COUNT(*) FILTER (score >= {t} AND label = 0) AS fp,
  COUNT(*) FILTER (score < {t} AND label = 1) AS fn, COUNT(*) FILTER (score < {t} AND label = 0) AS tn"""
COLUMNS = ("CustomerID", "InvoiceNo", "StockCode", "InvoiceDate", "Quantity", "Revenue")


def feature_table(clean, returns=None):
    split = churn.split_periods(clean)
    return split, churn.churn_features(split.feature, returns)


def fixed_score(clean):
    """(CustomerID, label, score) of the fixed score."""
    split, features = feature_table(clean)
    labels = churn.churn_labels(split.feature, split.outcome)
    first, last = date_span(split.feature)
    whole = (last - first).days + 1
    score = F.rint(F.col("recency") / F.lit(float(whole)) * 100) / 100
    return features.join(labels, "CustomerID").select(
        "CustomerID", F.col("churned").alias("label"), score.alias("score")
    )


def staged_score(spark, sf_dir):
    from patronage.session import stage

    return stage(fixed_score(staged_clean(spark, sf_dir, *COLUMNS)), "scored")


@query(with_clean(PERIODS_CTE) + "SELECT 'feature' AS part, COUNT(*) AS lines, MAX(feature_end) AS until "
       "FROM feat, ends UNION ALL SELECT 'outcome', (SELECT COUNT(*) FROM outc), outcome_end FROM ends")  # fmt: skip
def churn_periods(spark, sf_dir):
    split = churn.split_periods(staged_clean(spark, sf_dir, "InvoiceDate"))
    rows = [
        part.agg(F.lit(name).alias("part"), F.count("*").alias("lines")).withColumn(
            "until", F.lit(end).cast("timestamp_ntz")
        )
        for name, part, end in (
            ("feature", split.feature, split.feature_end),
            ("outcome", split.outcome, split.outcome_end),
        )
    ]
    return rows[0].unionByName(rows[1])


def _labels(clean):
    split = churn.split_periods(clean)
    return churn.churn_labels(split.feature, split.outcome)


@query(with_clean(PERIODS_CTE) + "SELECT * FROM labels_")
def churn_labels(spark, sf_dir):
    return _labels(staged_clean(spark, sf_dir, "CustomerID", "InvoiceDate"))


@query(with_clean(PERIODS_CTE, source=EVENT_RAW_SQL) + "SELECT * FROM labels_")
def churn_labels_events(spark, sf_dir):
    return _labels(staged_events(spark, sf_dir))


@query(with_clean(PERIODS_CTE, FEATURES_CTE, RETURNS_CTE)
       + "SELECT feats.*, COALESCE(return_rate, 0) AS return_rate FROM feats LEFT JOIN rets USING (CustomerID)")
def churn_features(spark, sf_dir):
    returns = customer_returns(raw_lines(spark, sf_dir), country=PARAMS.country)
    return feature_table(staged_clean(spark, sf_dir, *COLUMNS), returns)[1]


@query(with_clean(PERIODS_CTE, FEATURES_CTE, source=EVENT_RAW_SQL)
       + "SELECT *, 0.0::DOUBLE AS return_rate FROM feats")
def churn_features_events(spark, sf_dir):
    return feature_table(staged_events(spark, sf_dir))[1]


SCORE_CTES = (PERIODS_CTE, FEATURES_CTE, SCORED_CTE)


@query(with_clean(*SCORE_CTES) + "SELECT * FROM scored")
def churn_fixed_score(spark, sf_dir):
    return fixed_score(staged_clean(spark, sf_dir, *COLUMNS))


@query(with_clean(*SCORE_CTES) + f", c AS (SELECT {CELLS.format(t='0.5::DOUBLE')} FROM scored) " + """
SELECT 0 AS actual, 0 AS predicted, tn AS customers FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""")  # fmt: skip
def churn_confusion(spark, sf_dir):
    return scoring.confusion(staged_score(spark, sf_dir))


@query(with_clean(*SCORE_CTES) + f", c AS (SELECT {CELLS.format(t='0.5::DOUBLE')} FROM scored), " + """
r AS (SELECT *, COALESCE(tn / NULLIF(tn + fn, 0)::DOUBLE, 0) AS p0, COALESCE(tn / NULLIF(tn + fp, 0)::DOUBLE, 0) AS r0,
  COALESCE(tp / NULLIF(tp + fp, 0)::DOUBLE, 0) AS p1, COALESCE(tp / NULLIF(tp + fn, 0)::DOUBLE, 0) AS r1,
  (tn + fp)::DOUBLE AS n0, (tp + fn)::DOUBLE AS n1, tp + fp + fn + tn AS n FROM c),
f AS (SELECT *, COALESCE(2 * p0 * r0 / NULLIF(p0 + r0, 0), 0) AS f0,
  COALESCE(2 * p1 * r1 / NULLIF(p1 + r1, 0), 0) AS f1, (tp + tn) / n::DOUBLE AS acc FROM r)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, tn + fp AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, tp + fn FROM f UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n
FROM f""")  # fmt: skip
def churn_report(spark, sf_dir):
    return scoring.classification_report(staged_score(spark, sf_dir))


ROC_CTE = """
g AS (SELECT score, COUNT(*) FILTER (label = 1) AS p, COUNT(*) FILTER (label = 0) AS n FROM scored GROUP BY score),
c AS (SELECT *, SUM(p) OVER w AS cp, SUM(n) OVER w AS cn, SUM(p) OVER () AS tp, SUM(n) OVER () AS tn
  FROM g WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@query(with_clean(*SCORE_CTES, ROC_CTE) + """
SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, NULL::DOUBLE AS threshold
UNION ALL SELECT cn::DOUBLE / tn, cp::DOUBLE / tp, score FROM c""")  # fmt: skip
def churn_roc(spark, sf_dir):
    return scoring.roc_points(staged_score(spark, sf_dir))


@query(with_clean(*SCORE_CTES, ROC_CTE) + """
SELECT SUM(n * (2 * (cp - p) + p))::DOUBLE / (2 * MAX(tp)::DOUBLE * MAX(tn)) AS auc_roc FROM c""")  # fmt: skip
def churn_auc(spark, sf_dir):
    return scoring.auc(staged_score(spark, sf_dir))


IMPACT = """
tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
tp + fp AS total_interventions, (tp + fp) * 5.0::DOUBLE AS cost_of_interventions,
FLOOR(tp * 0.3::DOUBLE)::BIGINT AS recovered_churners, FLOOR(tp * 0.3::DOUBLE) * 200.0::DOUBLE AS revenue_saved,
fn * 200.0::DOUBLE AS missed_revenue, FLOOR(tp * 0.3::DOUBLE) * 200.0::DOUBLE - (tp + fp) * 5.0::DOUBLE AS net_roi,
COALESCE(ROUND_EVEN(FLOOR(tp * 0.3::DOUBLE) * 200.0::DOUBLE / NULLIF((tp + fp) * 5.0::DOUBLE, 0) * 100, 0) / 100, 0)
  AS roi_multiple"""


@query(with_clean(*SCORE_CTES) + f"SELECT 0.5::DOUBLE AS threshold, {IMPACT} "
       f"FROM (SELECT {CELLS.format(t='0.5::DOUBLE')} FROM scored)")  # fmt: skip
def churn_impact(spark, sf_dir):
    return scoring.business_impact(staged_score(spark, sf_dir))


@query(with_clean(*SCORE_CTES) + f"SELECT threshold, {IMPACT} FROM (SELECT threshold, {CELLS.format(t='threshold')} "
       "FROM scored, (SELECT UNNEST(RANGE(1, 20))::DOUBLE / 20 AS threshold) GROUP BY threshold)")  # fmt: skip
def churn_threshold_sweep(spark, sf_dir):
    return scoring.threshold_sweep(staged_score(spark, sf_dir))


BAND = """CASE WHEN score <= 0.3::DOUBLE THEN 'Low' WHEN score <= 0.6::DOUBLE THEN 'Medium'
  WHEN score <= 0.8::DOUBLE THEN 'High' ELSE 'Critical' END"""


def banded(spark, sf_dir):
    scored = staged_score(spark, sf_dir).withColumnRenamed("score", "churn_probability")
    return churn.with_risk_band(scored.drop("label"))


@query(with_clean(*SCORE_CTES) + f"SELECT CustomerID, score AS churn_probability, {BAND} AS churn_risk_band FROM scored")
def churn_bands(spark, sf_dir):
    return banded(spark, sf_dir)


def _actions_sql() -> str:
    rows = ", ".join(
        "('{}', '{}', '{}', {}::DOUBLE)".format(band, span, action.replace("'", "''"), cost)
        for band, (span, action, cost) in churn.RETENTION_ACTIONS.items()
    )
    return f"a(risk_level, probability_range, action, estimated_cost_per_customer) AS (VALUES {rows})"


@query(with_clean(*SCORE_CTES, _actions_sql()) + f"""
SELECT risk_level, probability_range, COALESCE(n, 0) AS customers,
  ROUND_EVEN(COALESCE(n, 0) / (SELECT COUNT(*) FROM scored)::DOUBLE * 100 * 100, 0) / 100 AS pct,
  action, estimated_cost_per_customer, COALESCE(n, 0) * estimated_cost_per_customer AS total_cost
FROM a LEFT JOIN (SELECT {BAND} AS risk_level, COUNT(*) AS n FROM scored GROUP BY ALL) USING (risk_level)""")  # fmt: skip
def churn_band_distribution(spark, sf_dir):
    return churn.band_distribution(banded(spark, sf_dir))


@query(with_clean(*SCORE_CTES) + "SELECT COUNT(*) FILTER (score >= 0.45::DOUBLE) AS flagged, "
       "COUNT(*) FILTER (score < 0.45::DOUBLE) AS kept FROM scored")  # fmt: skip
def churn_flagged(spark, sf_dir):
    from patronage.operators.master import flagged

    return flagged(staged_score(spark, sf_dir), 0.45, "score")


@query(with_clean(*SCORE_CTES) + f", b AS (SELECT *, {BAND} AS churn_risk_band FROM scored)"
       + histogram_sql("b", "score", "churn_risk_band"))
def churn_histogram_by_band(spark, sf_dir):
    scored = banded(spark, sf_dir).withColumnRenamed("churn_probability", "value")
    return charts.histogram(scored, ["churn_risk_band"])
