"""The master table over segments, the fixed value and the fixed churn score."""

from __future__ import annotations

from pyspark.sql import functions as F

from patronage.operators import churn, master, segments, value
from patronage.session import stage
from workloads.churn_queries import BAND, COLUMNS, SCORE_CTES, fixed_score
from workloads.registry import query
from workloads.retail import staged_clean, with_clean
from workloads.segment_queries import RFM_CTE
from workloads.segment_queries import SCORED_CTE as SEGMENTS_CTE
from workloads.value_queries import FINE, VALUED_CTE

MASTER_CTE = f"""
bands AS (SELECT CustomerID, score AS churn_probability, {BAND} AS band FROM scored),
joined AS (
  SELECT s.CustomerID, Recency, Frequency, Monetary, R_Score, F_Score, M_Score, RFM_Score, RFM_Agg_Score,
    Segment AS RFM_Segment, COALESCE(predicted_clv, 0) AS predicted_clv, COALESCE(CLV_Tier, 'Bronze') AS CLV_Tier,
    COALESCE(churn_probability, 0.5::DOUBLE) AS churn_probability, COALESCE(band, 'Medium') AS Churn_Risk_Band
  FROM segmented s LEFT JOIN tiered USING (CustomerID) LEFT JOIN bands USING (CustomerID)),
master AS (SELECT *, predicted_clv * churn_probability * CASE RFM_Segment WHEN 'At Risk' THEN 3.0::DOUBLE
  WHEN 'Potential Loyalists' THEN 2.0::DOUBLE WHEN 'Need Attention' THEN 2.0::DOUBLE
  WHEN 'Loyal Customers' THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS priority_score FROM joined)
"""
# The parts name the same steps alike; the churn ones come first and are renamed.
CTES = (*SCORE_CTES, RFM_CTE, SEGMENTS_CTE.replace("scores AS", "rfm_scores AS").replace("FROM scores)", "FROM rfm_scores)"), VALUED_CTE, MASTER_CTE)
RISKY = "Churn_Risk_Band IN ('High', 'Critical')"


def build(spark, sf_dir):
    clean = staged_clean(spark, sf_dir, *COLUMNS)
    rfm = stage(segments.segment_customers(clean), "segmented")
    valued = rfm.select(
        "CustomerID", (F.col("Monetary") / F.col("Frequency") * F.lit(0.15)).alias("predicted_clv")
    )
    tiered = value.assign_tiers(valued)[0]
    scored = fixed_score(clean).select("CustomerID", F.col("score").alias("churn_probability"))
    return stage(master.master_table(rfm, tiered, churn.with_risk_band(scored)), "master")


def registered(sql: str):
    return query(with_clean(*CTES) + sql)


@registered("SELECT * FROM master")
def master_table(spark, sf_dir):
    return build(spark, sf_dir)


@registered("SELECT * FROM master ORDER BY priority_score DESC, CustomerID LIMIT 50")
def priority_top_50(spark, sf_dir):
    return master.top_priority(build(spark, sf_dir))


def _group(name: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS insight, COUNT(*) AS customers, "
        f"COALESCE({FINE.format('predicted_clv')}, 0) AS total_clv FROM master WHERE {condition}"
    )


@registered(
    " UNION ALL ".join(
        [
            _group("highest_priority", f"RFM_Segment = 'At Risk' AND CLV_Tier IN ('Platinum', 'Gold') AND {RISKY}"),
            _group("leave_alone", "RFM_Segment = 'Champions' AND Churn_Risk_Band = 'Low'"),
            _group("let_go", f"RFM_Segment IN ('Lost', 'Hibernating') AND CLV_Tier = 'Bronze' AND {RISKY}"),
            _group("nurture", "RFM_Segment = 'Potential Loyalists' AND Churn_Risk_Band IN ('Medium', 'Low')"),
        ]
    )
)
def master_insights(spark, sf_dir):
    return master.insights(build(spark, sf_dir))


@registered(f"SELECT COUNT(*) AS customers, COALESCE({FINE.format('predicted_clv')}, 0) AS total_clv "
            f"FROM master WHERE {RISKY}")  # fmt: skip
def revenue_at_risk(spark, sf_dir):
    return master.revenue_at_risk(build(spark, sf_dir))


@registered(f"SELECT RFM_Segment, COUNT(*) AS customers, {FINE.format('predicted_clv')} AS total_clv "
            f"FROM master WHERE {RISKY} GROUP BY RFM_Segment")  # fmt: skip
def revenue_at_risk_by_segment(spark, sf_dir):
    return master.revenue_at_risk_by_segment(build(spark, sf_dir))


@registered("SELECT CLV_Tier, Churn_Risk_Band, RFM_Segment, COUNT(*) AS customers FROM master GROUP BY ALL")
def master_combinations(spark, sf_dir):
    return master.combinations(build(spark, sf_dir))


@registered("SELECT COUNT(*) FILTER (RFM_Segment IN ('At Risk', 'Champions') AND CLV_Tier IN ('Gold', 'Silver') "
            "AND Churn_Risk_Band IN ('Low', 'Medium')) AS shown, COUNT(*) AS total FROM master")  # fmt: skip
def master_selection(spark, sf_dir):
    return master.selection_size(
        build(spark, sf_dir),
        segments=["At Risk", "Champions"],
        tiers=["Gold", "Silver"],
        bands=["Low", "Medium"],
    )


@registered("SELECT COUNT(*) AS customers, " + FINE.format("Monetary") + " AS total_revenue, "
            + FINE.format("Monetary") + " / COUNT(*) AS revenue_per_customer, "
            + ", ".join(f"COUNT(*) FILTER (CLV_Tier = '{t}') AS {t.lower()}_customers"
                        for t in ("Platinum", "Gold", "Silver", "Bronze")) + " FROM master")
def summary_cards(spark, sf_dir):
    return master.summary_cards(build(spark, sf_dir))
