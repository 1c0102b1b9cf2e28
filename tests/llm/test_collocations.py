from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from patronage.llm.collocations import best_cut, collocations
from patronage.llm.phrases import Pieces, sequence_hashes
from patronage.llm.text import blocks
from tests.llm.helpers import awkward, empty

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def pieces(text):
    parts = re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER))
    return [w for w in (re.findall("[^\x20\x09]+", p) for p in parts) if w]


def brute(rows, least, longest=5, keep=2000):
    """Rows as (lang, text); every phrase counted, every longer phrase looked at."""
    count = defaultdict(Counter)
    for lang, text in rows:
        for words in pieces(text):
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        found = {p: v for p, v in f.items() if len(p) > 1 and v >= least}
        held = set()
        for p, v in found.items():
            for size in range(2, len(p)):
                held |= {q for i in range(len(p) - size + 1) if 100 * v >= 100 * f[q := p[i : i + size]]}
        scored = []
        for p in set(found) - held:
            parts = [(f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, left, right = min(((1000 * f[p] * n // (x * y), x, y) for x, y in parts), key=lambda c: c[0])
            scored.append((-score, -f[p], " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:keep], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def pairs(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute(pairs(docs), 12)
    assert len(want) > 100
    assert got(collocations(docs, least=12)) == want


@pytest.mark.parametrize("first, settle, most", [(0.05, 2, 1000), (0.5, 5, 7)])
def test_small_batches_and_few_places(spark, first, settle, most):
    pick = random.Random(settle)
    vocabulary = [f"w{i}" for i in range(25)]
    weights = [1 / (i + 1) for i in range(25)]
    passage = "alpha beta, gamma delta Epsilon zeta eta"
    rows = []
    for i in range(150):
        words = pick.choices(vocabulary, weights, k=30)
        text = " ".join(w + pick.choice(["", "", "", ".", "  ", "\t"]) for w in words)
        rows.append((pick.choice(["x", "y", None]), text + pick.choice(["", "! " + passage, "\n" + passage.upper()])))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    for keep in (4, 60):
        want = brute(rows, 10, keep=keep)
        found = collocations(docs, least=10, keep=keep, first_share=first, settle=settle, most_words=most)
        assert got(found) == want


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert got(collocations(docs, least=2)) == brute(pairs(docs), 2)


def test_empty_table(spark):
    assert collocations(empty(spark)).collect() == []
    assert collocations(empty(spark)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_cuts_are_exact_and_first_of_equal_ones():
    big = 10**13
    assert best_cut(big, 10**14, [(big, big + 1), (big + 1, big)]) == (1000 * 10**14 // (big + 1), big, big + 1)
    assert best_cut(100, 10**6, [(200, 300), (150, 400)]) == (1666666, 200, 300)


def test_hashes_of_phrases_are_those_found_in_texts():
    (_, block), = blocks(pa.array(["One  two\tthree. four"]))
    found = Pieces(block)
    groups = np.array([5], dtype=np.uint64)
    hashes = found.extend(found.extend(found.begin(groups)[:1], np.array([1])), np.array([2]))
    assert found.follows.tolist() == [False, True, True, False]
    one, two = sequence_hashes([("en", "one two three"), ("en", "one")])
    assert one != two and sequence_hashes([("fr", "one")])[0] != two
    (_, again), = blocks(pa.array(["x", "one two three"]))
    from patronage.llm.phrases import group_hashes

    at = Pieces(again)
    en = group_hashes(pa.array(["en", "en"]))
    chain = at.extend(at.extend(at.begin(en)[1:2], np.array([2])), np.array([3]))
    assert chain[0] == one and hashes[0] != one
