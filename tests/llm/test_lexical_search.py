from __future__ import annotations

import re
from collections import Counter
from math import floor, log

import pytest

from patronage.llm import lexical_search
from patronage.llm.lexical_search import ranked_search
from tests.llm.helpers import awkward, empty, mirrored

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc, c in counted:
            m, score = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_words, 0
            for t in set(terms(text)):
                w = floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        for rank, (score, known, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((str(item), rank, str(doc if known else None), -score))
    return sorted(out)


def got(df):
    return sorted((str(r.item_id), r.rank, str(r.doc_id), r.score) for r in df.collect())


def pairs(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def compare(docs, items, **options):
    want = brute(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"), options.get("k", 50))
    assert got(ranked_search(docs, items, **options)) == want
    return want


def test_whole_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert compare(docs, spark.read.parquet(f"{small}/benchmark.parquet"))


def test_small_shards_steps_and_blocks(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(2)
    compare(docs, spark.read.parquet(f"{small}/benchmark.parquet"), k=3, block_terms=40)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string, doc_id int, score string")


def test_awkward_rows(spark):
    items = items_of(spark, [
        ("a", "the quick fox", 1, ""), ("a", "the quick fox", 1, ""), ("b", None, 1, ""), ("c", " .,", 1, ""),
        (None, "LONG words nobody", 1, ""), ("d", "日本語のテキストには空白がない absent", 1, ""),
    ])
    assert compare(awkward(spark), items, k=2)


def test_empty_tables(spark):
    items = items_of(spark, [("a", "the fox", 1, "")])
    assert ranked_search(empty(spark), items).collect() == []
    assert ranked_search(awkward(spark), items.limit(0)).collect() == []
    assert ranked_search(empty(spark), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, "same words here" if i % 2 else "other words here too") for i in range(200, 0, -1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    compare(docs, items_of(spark, [("x", "same words", 1, ""), ("y", "too here", 1, "")]))


@pytest.mark.parametrize("step", [1, 7])
def test_reading_stops_only_when_all_is_settled(step, monkeypatch):
    import numpy as np

    monkeypatch.setattr(lexical_search, "FIRST_STEP", step)
    rng = np.random.default_rng(step)
    for _ in range(30):
        docs, kinds = int(rng.integers(1, 80)), 12
        tf = rng.integers(0, 4, (docs, kinds)) * (rng.random((docs, kinds)) < 0.5)
        row, term = np.nonzero(tf)
        lengths = tf.sum(axis=1) + 3
        weight = rng.integers(0, 5, kinds)
        query = lexical_search.Query(weight, [], docs, int(lengths.sum()), 5)
        shard = lexical_search.Shard(lengths, np.bincount(row, minlength=docs), term, tf[row, term], query)
        own = np.sort(rng.choice(kinds, 6, replace=False))
        found = dict(zip(*(a.tolist() for a in shard.best(own))))
        every = lexical_search.impacts(tf, lengths[:, None], weight, docs, int(lengths.sum()))[:, own].sum(axis=1)
        want = sorted(every[every > 0].tolist(), reverse=True)[:5]
        assert sorted(found.values(), reverse=True)[:5] == want
        assert all(every[d] == s for d, s in found.items())
        if len(want) == 5:
            assert {int(d) for d in np.flatnonzero(every >= want[-1])} == set(found)


def test_mirrored_words_are_told_apart(spark):
    one, other = mirrored()
    docs = spark.createDataFrame([(1, one), (2, other), (3, "x")], "doc_id bigint, text string").coalesce(1)
    assert [r.doc_id for r in ranked_search(docs, items_of(spark, [("a", one, 1, "")])).collect()] == [1]
