from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from patronage.llm.suffix_dedup import suffix_dedup, suffix_digest
from patronage.llm.suffixes import SMALL, characters, common_prefixes, multikey_order
from tests.llm.helpers import BASE, awkward, empty


def brute(docs, span=50):
    """Rows as (doc_id, text); the contract, byte by byte."""
    first: dict[bytes, float] = {}
    place = lambda i: float("-inf") if i is None else i
    for doc, text in docs:
        raw = (text or "").encode()
        for p in range(len(raw) - span + 1):
            w = raw[p : p + span]
            first[w] = min(first.get(w, float("inf")), place(doc))
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for p in range(len(raw) - span + 1):
            if first[raw[p : p + span]] < place(doc):
                gone[p : p + span] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(raw) else 0
        out.append((str(doc), len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute(pairs(docs))
    assert sum(r[2] for r in want) > 1000
    assert got(suffix_digest(docs)) == want


@pytest.mark.parametrize("bucket_bytes", [1 << 25, 20_000])
def test_awkward_rows(spark, bucket_bytes):
    docs = awkward(spark)
    assert got(suffix_digest(docs, bucket_bytes=bucket_bytes)) == brute(pairs(docs))


def test_empty_table(spark):
    assert suffix_dedup(empty(spark)).collect() == []


def test_a_string_that_all_texts_hold_crosses_many_buckets(spark):
    pick = random.Random(11)
    word = lambda: "".join(pick.choice("abcd") for _ in range(pick.randint(2, 9)))
    lines = [" ".join(word() for _ in range(14)) for _ in range(4)]
    rows = []
    for i in range(400):
        own = [word() for _ in range(20)]
        own.insert(pick.randint(0, 20), pick.choice(lines[: 1 + i % 4]))
        rows.append((pick.randint(0, 300), " ".join(own)))
    rows += [(i, "ab" * 400) for i in range(5)] + [(9, "a" * 2000), (10, "a" * 60), (11, "a" * 50 + "b")]
    docs = table(spark, rows)
    assert got(suffix_digest(docs, bucket_bytes=1500)) == brute(rows)


@pytest.mark.parametrize("span", [16, 33])
def test_other_spans_with_zero_bytes(spark, span):
    pick = random.Random(span)
    rows = [(i, "".join(pick.choice("\0\0\0a\n") for _ in range(pick.randint(0, 300)))) for i in range(60)]
    assert got(suffix_digest(table(spark, rows), span=span, bucket_bytes=4000)) == brute(rows, span)


def test_kept_bytes_and_spans(spark):
    text = BASE + " and then something else"
    rows = table(spark, [(1, BASE), (2, "Before. " + text)])
    found = {r.doc_id: r for r in suffix_dedup(rows).collect()}
    assert bytes(found[1].kept).decode() == BASE and found[1].starts == []
    assert bytes(found[2].kept).decode() == "Before.  and then something else"
    assert (found[2].starts, found[2].ends) == ([8], [8 + len(BASE)])


def test_multikey_order_is_the_order_of_bytes():
    rng = np.random.default_rng(5)
    parts = rng.integers(0, 3, (3 * SMALL, 24)).astype(np.uint8)
    parts[::3] = parts[0]
    order = multikey_order(characters(parts))
    rows = [bytes(parts[i]) for i in order]
    assert rows == sorted(bytes(p) for p in parts) and sorted(order.tolist()) == list(range(len(parts)))
    common = common_prefixes(parts, order)
    for i in (1, 7, 100, 5000):
        same = [a == b for a, b in zip(rows[i - 1], rows[i])]
        assert common[i] == (same.index(False) if False in same else 24)
