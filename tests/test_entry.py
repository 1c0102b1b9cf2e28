from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
CORE = sorted(n for n, f in entry.queries().items() if f.__module__.startswith("workloads."))
# One of each kind; the driver compares them all.
COMPARED = ("clean_transactions", "cleaning_report", "rfm_scored", "repeat_summary", "churn_features_events", "churn_report", "master_table")


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(CORE) > 60


@pytest.mark.parametrize("name", COMPARED)
def test_matches_sql(spark, small, name):
    db = duckdb.connect()
    for table in TABLES:
        if os.path.exists(f"{small}/{table}.parquet"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    df = entry.queries()[name](spark, small)
    assert sorted(df.columns) == sorted(columns)

    def plain(v):
        return round(v, 6) if isinstance(v, float) else v

    want = sorted(str([plain(v) for v in row]) for row in cursor.fetchall())
    got = sorted(str([plain(row[c]) for c in columns]) for row in df.collect())
    assert got == want
