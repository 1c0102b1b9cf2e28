from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from patronage.session import stage
from tests.llm.helpers import awkward, empty
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_exact_dedup import brute as exact_groups
from tests.llm.test_near_dedup import brute as near_classes


def test_stages_match_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    kept = {}
    for name, apply in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = stage(apply(spark, docs, small), name)
        kept[name] = before
        if name != "packing":
            assert docs.columns == columns
        got = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "language_id":
            assert got == {i for i, t in before if any(map(str.isalpha, t or ""))}
        elif name == "exact_dedup":
            assert got == {int(x[0]) for x in exact_groups(before) if x[3]}
        elif name == "near_dedup":
            assert got == set(near_classes(before).values())
        elif name == "decontamination":
            assert got == {int(x[0]) for x in contaminated(before, items) if not x[5]}
        else:
            assert got == {i for i, _ in before}
    places = defaultdict(list)
    for r in docs.collect():
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        ends = [o + n for o, n in sorted(spans)]
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 4096


def test_awkward_rows_pass_through(spark, small):
    docs = awkward(spark)
    for name, apply in corpus_pipeline.STAGES:
        rows = stage(apply(spark, docs, small), name)
        if name != "packing":
            assert rows.columns == awkward(spark).columns and rows.schema == docs.schema
        kept = {r.doc_id for r in rows.select("doc_id").collect()}
        # What has no letter goes first, then copies; nothing else here is near or known.
        assert not kept & {3, 4, 5, 6} and kept >= {7, 8, 9, 11, 12, None}
        docs = rows
    assert {2} & {r.doc_id for r in docs.collect()} == set()


def test_empty_tables_pass_through(spark, small):
    docs = empty(spark)
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, small), name)
        assert docs.count() == 0
        if name != "packing":
            assert docs.columns == empty(spark).columns
