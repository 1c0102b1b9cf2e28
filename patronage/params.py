"""Business numbers in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # The defaults give the same results as the specification.
    country: str | None = "United Kingdom"
    max_quantity: float = 5000
    max_unit_price: float = 500

    calibration_months: int = 9
    holdout_months: int = 3
    feature_months: int = 9
    outcome_days: int = 90

    penalizer: float = 0.01
    horizon_months: float = 6
    days_per_month: float = 30.44
    profit_margin: float = 0.15
    cac: float = 380.0
    cac_per_currency_unit: float = 105.0

    test_share: float = 0.2
    seed: int = 42
    neighbours: int = 5
    regression_trees: int = 200
    regression_tree_depth: int = 10
    boosting_rounds: int = 300
    regression_boost_depth: int = 6
    churn_boost_depth: int = 5
    learning_rate: float = 0.05
    subsample: float = 0.8
    logistic_iterations: int = 1000

    customer_revenue: float = 200.0
    intervention_cost: float = 5.0
    recovery_rate: float = 0.30
    decision_threshold: float = 0.5

    top_customers: int = 50
