from __future__ import annotations

import glob
import os

import pytest

from patronage import batch
from patronage.sources import tables
from workloads.retail import PARAMS, raw_lines

OUTPUTS = (
    "cleaned_transactions customer_table cohort_retention rfm_scored segment_summary pareto_analysis "
    "clv_statistical clv_features budget_analysis threshold_sweep churn_features churn_predictions "
    "priority_top_50 master_customer_table"
).split()


def test_a_run_from_raw_lines_to_published_tables(spark, small, tmp_path):
    root, raw = str(tmp_path / "out"), raw_lines(spark, small)
    with pytest.raises(FileNotFoundError):
        batch.current_run(spark, root)
    failures = []

    def breaks(run):
        failures.append(run.folder)
        raise RuntimeError("lost")

    steps = [s if s[0] != "churn" else ("churn", breaks) for s in batch.STEPS]
    params = batch.few_trees(PARAMS)
    with pytest.raises(RuntimeError):
        batch.run_batch(raw, root, "one", params, steps=steps)
    assert failures and not os.path.exists(f"{root}/{batch.CURRENT}")
    before = os.path.getmtime(f"{root}/runs/one/rfm_scored")
    scratch = spark.conf.get("spark.checkpoint.dir")
    staged = set(glob.glob(f"{scratch}/patronage-*/*"))

    folder = batch.run_batch(raw, root, "one", params)  # goes on
    assert os.path.getmtime(f"{root}/runs/one/rfm_scored") == before
    assert set(glob.glob(f"{scratch}/patronage-*/*")) == staged  # nothing staged is left
    assert batch.current_run(spark, root) == folder
    for name in OUTPUTS:
        table = batch.load_current(spark, root, name)
        assert table.columns == tables.table_schema(name).fieldNames() and table.count() > 0
    customers = batch.load_current(spark, root, "master_customer_table")
    assert customers.count() == batch.load_current(spark, root, "rfm_scored").count()
    assert batch.load_current(spark, root, "priority_top_50").count() == 50
    results = tables.read_report(spark, folder, "hypothesis_results").collect()
    assert {r["hypothesis"][:2] for r in results} == {"H1", "H2", "H3"}
    assert "h3_churn_validated" in {r["metric"] for r in results}
    assert tables.read_report(spark, folder, "cleaning_report").first()["clean_rows"] > 0

    # A loaded model scores as the fitted one did.
    model = tables.load_model(f"{folder}/models", "churn_boosted_trees")
    scored = batch.models.churn_scores(model, batch.load_current(spark, root, "churn_features"))
    again = {r.CustomerID: r.score for r in scored.collect()}
    given = batch.load_current(spark, root, "churn_predictions").collect()
    assert all(again[r.CustomerID] == r.churn_probability for r in given)
    assert tables.load_clv(spark, folder).count() == batch.load_current(spark, root, "clv_statistical").count()

    path = batch.export_selection(spark, root, str(tmp_path / "down"), bands=["High", "Critical"])
    exported = spark.read.option("header", True).csv(path).count()
    assert exported == customers.where("Churn_Risk_Band in ('High', 'Critical')").count()


def test_values_fall_back_to_regression(spark, small, tmp_path, monkeypatch):
    def fails(*_):
        raise batch.repeat_fit.NotFitted("no maximum")

    monkeypatch.setattr(batch, "fitted_values", fails)
    steps = [s for s in batch.STEPS if s[0] in ("clean", "value")]
    folder = batch.run_batch(raw_lines(spark, small), str(tmp_path), "two", batch.few_trees(PARAMS), steps=steps)
    values = tables.read_table(spark, folder, "customer_values")
    assert values.count() == tables.read_table(spark, folder, "clv_features").count()
    assert values.where("predicted_clv < 0 or CLV_Tier is null").count() == 0
    assert tables.load_clv(spark, folder).columns == tables.table_schema("clv_features").fieldNames()
