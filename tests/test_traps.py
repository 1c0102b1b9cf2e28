"""One test per semantic trap and per fixed defect."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from patronage.functions.columns import elapsed_days, round_even
from patronage.functions.rules import quartile_score, risk_band, segment
from patronage.operators import churn, cleaning, master, profile, scoring, segments, value
from patronage.operators.ranking import exact_quantiles, running_totals
from patronage.params import Params
from patronage.sources import tables
from tests.rows import CLEAN, RAW, at, lines


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_elapsed_days_are_not_calendar_days(spark):
    df = spark.createDataFrame([(at("2020-01-01 23:00"), at("2020-01-03 01:00"))], "a timestamp_ntz, b timestamp_ntz")
    assert one(df.select(elapsed_days("a", "b").alias("d"))).d == 1


def test_rounding_is_half_even(spark):
    assert one(spark.range(1).select(round_even(F.lit(0.125)).alias("x"))).x == 0.12


def test_frequency_ranks_with_ties(spark):
    rfm = spark.createDataFrame([(i, 10, 1, float(i)) for i in range(6)], "CustomerID bigint, Recency int, Frequency bigint, Monetary double")
    rows = segments.score_rfm(rfm).orderBy("CustomerID").collect()
    assert [r.F_Score for r in rows] == [1, 1, 2, 3, 4, 4]


def test_tied_quartiles(spark):
    rfm = spark.createDataFrame(
        [(i, r, 1, 5.0) for i, r in enumerate((1, 1, 1, 1, 1, 2, 3))],
        "CustomerID bigint, Recency int, Frequency bigint, Monetary double",
    )
    rows = segments.score_rfm(rfm).orderBy("CustomerID").collect()
    assert [r.R_Score for r in rows] == [4, 4, 4, 4, 4, 1, 1]


def test_missing_values_get_no_score(spark):
    rfm = spark.createDataFrame(
        [(1, None, 1, 5.0), (2, 3, 1, None), (3, 4, 2, 6.0), (4, 9, 2, 7.0)],
        "CustomerID bigint, Recency int, Frequency bigint, Monetary double",
    )
    rows = {r.CustomerID: r for r in segments.map_segments(segments.score_rfm(rfm)).collect()}
    assert rows[1].R_Score is None and rows[2].M_Score is None
    assert rows[1].Segment == rows[2].Segment == "Others"
    df = spark.createDataFrame([(None,)], "x double")
    assert one(df.select(quartile_score(F.col("x"), [1, 2, 3]).alias("s"))).s is None


def test_segments_are_total(spark):
    grid = [(r, f, m) for r in range(1, 5) for f in range(1, 5) for m in range(1, 5)]
    df = spark.createDataFrame(grid, "r int, f int, m int").select("r", "f", "m", segment(F.col("r"), F.col("f"), F.col("m")).alias("s"))
    rows = {(x.r, x.f, x.m): x.s for x in df.collect()}
    assert "Others" not in rows.values()
    assert rows[1, 1, 1] == "Lost" and rows[4, 4, 4] == "Champions" and rows[2, 3, 3] == "At Risk"


def test_risk_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.3, 0.30001, 0.6, 0.8, 1.0, 1.1, None)], "p double")
    got = [r.b for r in df.select(risk_band(F.col("p")).alias("b")).collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High", "Critical", None, None]


def test_empty_months_are_zero(spark):
    rows = profile.monthly_revenue(lines(spark, (1, "a", "2020-01-05", 3), (1, "b", "2020-04-02", 4))).collect()
    assert [r.revenue for r in rows] == [3, 0, 0, 4]
    far = lines(spark, (1, "a", "0001-01-05", 3), (1, "b", "9999-04-02", 4))
    assert profile.monthly_revenue(far).count() == 9998 * 12 + 4


def test_null_country_is_removed(spark):
    raw = spark.createDataFrame([("1", "p", 1, at("2020-01-01"), 1.0, 1, c) for c in (None, "X")], RAW)
    assert one(cleaning.cleaning_report(raw)).non_uk_rows_removed == 2


def test_report_counts_missing_invoices_and_dates(spark):
    raw = spark.createDataFrame(
        [(None, "p", "1", "soon", 1.0, "7.0", "United Kingdom"), ("2", "p", "1", "2020-01-01", 1.0, "7.0", "United Kingdom")],
        "InvoiceNo string, StockCode string, Quantity string, InvoiceDate string, UnitPrice double, CustomerID string, Country string",
    )
    row = one(cleaning.cleaning_report(raw))
    assert (row.null_invoice_rows, row.undated_rows, row.clean_rows, row.unique_customers) == (1, 1, 2, 1)
    dated = cleaning.normalise(raw.withColumn("InvoiceDate", F.lit("03.02.2021")), formats=("dd.MM.yyyy",))
    assert dated.first().InvoiceDate == at("2021-02-03")


def test_same_day_repeat(spark):
    row = one(value.repeat_summary(lines(spark, (1, "a", "2020-01-01 09:00", 5), (1, "b", "2020-01-01 15:00", 7)), at("2020-02-01")))
    assert (row.frequency, row.recency, row.monetary_value) == (1, 0, 7)


def test_cancelled_lines(spark):
    rows = [("1", "p", 1, at("2020-01-01"), 1.0, 1, "X")] + [("C2", "p", -1, at("2020-01-02"), 1.0, 1, "X")] * 3
    row = one(cleaning.customer_returns(spark.createDataFrame(rows, RAW), country=None))
    assert (row.cancelled_orders, row.return_rate) == (3, 1.5)


def test_order_across_the_middle_counts_twice(spark):
    feature = lines(
        spark, (1, "a", "2020-01-01", 1), (1, "s", "2020-01-05", 2), (1, "s", "2020-01-07", 2), (1, "z", "2020-01-11", 9)
    )
    row = one(churn.churn_features(feature))
    assert row.purchase_frequency_change == 0  # a and s early, s and z late
    assert row.order_value_trend == pytest.approx((9 - 1) / 3)


def test_periods_are_disjoint_and_capped(spark):
    clean = lines(spark, *[(i, str(i), f"2020-{m:02}-01", 1) for i, m in enumerate(range(1, 13))])
    split = churn.split_periods(clean, Params(feature_months=11))
    assert split.outcome_end == at("2020-12-01")
    both = split.feature.intersect(split.outcome).count()
    assert both == 0 and split.feature.count() + split.outcome.count() == 12


def test_zero_value_tier(spark):
    df = spark.createDataFrame([(1, 0.0, "Bronze")], "CustomerID bigint, predicted_clv double, CLV_Tier string")
    assert one(value.budget_by_tier(df)).cac_as_pct_of_clv is None


def test_scores_are_not_rounded_before_adding(spark):
    df = spark.createDataFrame([(i, i / 7, "Gold") for i in range(1, 8)], "CustomerID bigint, predicted_clv double, CLV_Tier string")
    row = one(value.budget_by_tier(df))
    assert row.total_clv == pytest.approx(4, abs=1e-11) and row.avg_clv == pytest.approx(4 / 7, abs=1e-12)


def test_roc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.8), (0, 0.1)], "label int, score double")
    assert one(scoring.auc(df)).auc_roc == 0.875
    points = {(r.fpr, r.tpr) for r in scoring.roc_points(df).collect()}
    assert points == {(0, 0), (0, 0.5), (0.5, 1), (1, 1)}


def test_impact_identities(spark):
    pick = random.Random(1)
    df = spark.createDataFrame([(pick.randint(0, 1), pick.randrange(100) / 100) for _ in range(500)], "label int, score double")
    sweep = scoring.threshold_sweep(df).collect()
    assert len(sweep) == 19
    for r in sweep:
        assert r.true_positives + r.false_positives + r.false_negatives + r.true_negatives == 500
    half = one(scoring.business_impact(df))
    assert half == next(r for r in sweep if r.threshold == 0.5)


def test_large_amounts(spark):
    clean = lines(spark, *[(i, str(i), f"2020-01-{i + 1:02}", 4e14) for i in range(6)])
    assert one(profile.revenue_profile(clean)).total_revenue == 2.4e15
    scored = segments.segment_customers(clean)
    assert sum(r.total_revenue for r in segments.segment_summary(scored).collect()) == 2.4e15
    assert one(segments.validate_h1(scored)).top_20_customer_count >= 1
    assert segments.concentration(segments.compute_rfm(clean)).agg(F.max("cum_revenue_pct")).first()[0] == 100
    assert one(profile.monthly_revenue(clean)).revenue == 2.4e15


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "CustomerID bigint, Recency int, Frequency bigint, Monetary double")
    scored = segments.map_segments(segments.score_rfm(none))
    assert scored.collect() == []
    assert segments.segment_summary(scored).collect() == []
    assert one(segments.validate_h1(scored)).top_20_customer_count == 0
    assert segments.concentration(none).collect() == []
    values = spark.createDataFrame([], "CustomerID bigint, predicted_clv double")
    tiered, bounds = value.assign_tiers(values)
    assert tiered.collect() == [] and bounds.count() == 4
    assert value.budget_by_tier(tiered).collect() == []
    assert one(value.validate_h2(values)).unprofitable_count == 0
    scores = spark.createDataFrame([], "label int, score double")
    assert one(scoring.auc(scores)).auc_roc is None
    assert sum(r.customers for r in scoring.confusion(scores).collect()) == 0
    report = cleaning.cleaning_report(spark.createDataFrame([], RAW))
    assert one(report).raw_rows == 0
    assert cleaning.clean_transactions(spark.createDataFrame([], RAW)).columns == spark.createDataFrame([], CLEAN).columns


def test_csv_parts_line_up_by_name(spark, tmp_path):
    folder = tmp_path / "raw.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Invoice,StockCode,Quantity,InvoiceDate,Price,Customer ID,Country\n1,p,6,2020-01-01,4.5,7.0,X\n")
    (folder / "b.csv").write_text("Invoice,StockCode,Price,Quantity,InvoiceDate,Customer ID,Country\n2,p,2.5,3,2020-01-01,8.0,X\n")
    rows = {r.InvoiceNo: r for r in tables.load_raw(spark, str(folder)).collect()}
    assert (rows["1"].Quantity, rows["1"].UnitPrice) == ("6", 4.5)
    assert (rows["2"].Quantity, rows["2"].UnitPrice) == ("3", 2.5)
    with pytest.raises(ValueError):
        tables.load_raw(spark, "raw.xlsx")


@pytest.mark.parametrize("few", [3, 10_000])
def test_running_totals_match_a_single_window(spark, few):
    pick = random.Random(few)
    rows = [(i, float(pick.randrange(few)), pick.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, x double, v bigint")
    got = running_totals(df, "x", tie="id", descending=True, sums={"run": "v"}, count="n").collect()
    total, rank = 0, 0
    for i, x, v in sorted(rows, key=lambda r: (-r[1], r[0])):
        total, rank = total + v, rank + 1
        rows[i] = (rank, total)
    assert all((r["rank"], r.run) == rows[r.id] and r.n == 3000 for r in got)


def test_exact_quantiles_match_percentile(spark):
    pick = random.Random(3)
    df = spark.createDataFrame([(pick.gauss(0, 9),) for _ in range(2001)], "x double")
    want = df.agg(F.percentile("x", [0.1, 0.5, 0.95])).first()[0]
    assert exact_quantiles(df, ["x"], [0.1, 0.5, 0.95])["x"] == pytest.approx(want)


def test_top_priority_ties(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(100)], "CustomerID bigint, priority_score double")
    assert [r.CustomerID for r in master.top_priority(df).collect()] == list(range(50))


def test_no_single_partition_over_customers(spark):
    """Ranks do not bring all customers into one task, and nothing runs in Python."""
    df = spark.range(5000).select(F.col("id").alias("CustomerID"), (F.col("id") % 7).cast("double").alias("Monetary"))
    plan = segments.concentration(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    window = plan.index("Window [row_number")
    assert "SinglePartition" not in plan[window : plan.index("BroadcastExchange", window)]
