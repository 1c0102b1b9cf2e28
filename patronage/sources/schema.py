"""Declared schemas of the tables that go in and out."""

from __future__ import annotations

from pyspark.sql import types as T

# Alternative column names of the raw file.
ALIASES = {"Invoice": "InvoiceNo", "Customer ID": "CustomerID", "Price": "UnitPrice"}

# Text in, so that a bad value becomes null for one field and not for the file.
RAW_FIELDS = {
    "InvoiceNo": "string",
    "StockCode": "string",
    "Quantity": "string",
    "InvoiceDate": "string",
    "UnitPrice": "double",
    "CustomerID": "string",
    "Country": "string",
}

_TRANSACTIONS = (
    "InvoiceNo string, StockCode string, Quantity int, InvoiceDate timestamp_ntz, "
    "UnitPrice double, CustomerID bigint, Country string"
)
_RFM = (
    "CustomerID bigint, Recency int, Frequency bigint, Monetary double, "
    "reference_date timestamp_ntz, R_Score int, F_Score int, M_Score int, "
    "RFM_Score string, RFM_Agg_Score int, Segment string"
)
_MASTER = (
    "CustomerID bigint, Recency int, Frequency bigint, Monetary double, R_Score int, "
    "F_Score int, M_Score int, RFM_Score string, RFM_Agg_Score int, RFM_Segment string, "
    "predicted_clv double, CLV_Tier string, churn_probability double, "
    "Churn_Risk_Band string, priority_score double"
)

# Output tables by name, with their columns. CSV carries no types, so reading back uses these.
TABLES = {
    "cleaned_transactions": _TRANSACTIONS + ", is_cancellation boolean, Revenue double",
    "customer_table": (
        "CustomerID bigint, first_purchase timestamp_ntz, last_purchase timestamp_ntz, "
        "frequency bigint, total_revenue double, total_quantity bigint, "
        "unique_products bigint, avg_order_value double, recency_days int, "
        "tenure_days int, avg_days_between_purchases double, reference_date timestamp_ntz"
    ),
    "cohort_retention": (
        "cohort_month date, period_index int, customers bigint, retention_pct double"
    ),
    "rfm_scored": _RFM,
    "segment_summary": (
        "Segment string, customer_count bigint, avg_recency double, avg_frequency double, "
        "avg_monetary double, total_revenue double, median_monetary double, "
        "pct_customers double, pct_revenue double"
    ),
    "pareto_analysis": (
        "CustomerID bigint, Monetary double, cum_revenue_pct double, cum_customer_pct double"
    ),
    "clv_statistical": (
        "CustomerID bigint, frequency bigint, recency int, T int, monetary_value double, "
        "expected_purchases double, prob_alive double, expected_avg_profit double, "
        "predicted_clv double, CLV_Tier string"
    ),
    "clv_features": (
        "CustomerID bigint, recency int, frequency bigint, monetary double, "
        "avg_order_value double, unique_products bigint, total_quantity bigint, "
        "tenure_days int, avg_days_between double, items_per_order double, "
        "holdout_revenue double"
    ),
    "budget_analysis": (
        "CLV_Tier string, customer_count bigint, avg_clv double, median_clv double, "
        "total_clv double, cac_gbp double, profit_per_customer double, "
        "cac_as_pct_of_clv double, is_profitable boolean"
    ),
    "threshold_sweep": (
        "threshold double, true_positives bigint, false_positives bigint, "
        "false_negatives bigint, true_negatives bigint, total_interventions bigint, "
        "cost_of_interventions double, recovered_churners bigint, revenue_saved double, "
        "missed_revenue double, net_roi double, roi_multiple double"
    ),
    "churn_features": (
        "CustomerID bigint, recency int, frequency bigint, monetary double, "
        "unique_products_bought bigint, total_quantity bigint, avg_order_value double, "
        "days_since_first_purchase int, is_single_purchase_customer int, "
        "avg_days_between_purchases double, purchases_last_30_days bigint, "
        "purchases_last_60_days bigint, purchase_frequency_change bigint, "
        "order_value_trend double, return_rate double"
    ),
    "churn_predictions": (
        "CustomerID bigint, churn_probability double, churn_risk_band string"
    ),
    "priority_top_50": _MASTER,
    "master_customer_table": _MASTER,
}


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])
