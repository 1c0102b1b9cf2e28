from __future__ import annotations

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from patronage.llm.packing import Plan, make_plan, non_negative_fit, pack_documents, patterns
from tests.llm.helpers import awkward, empty, mirrored

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def check(docs, capacity=4096, slack=1.02):
    rows = pack_documents(docs, PATH, capacity=capacity).collect()
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length >= 1
            at += length
        assert at <= capacity
    want = Counter()
    for d in docs.select("doc_id", "text").collect():
        ids = [*LIBRARY.encode(d.text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[d.doc_id, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    total = sum(r.length for r in rows)
    assert len(places) <= 1 + slack * total / capacity


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_small_sequences(spark, small):
    check(spark.read.parquet(f"{small}/documents.parquet"), capacity=100)


def test_awkward_rows(spark):
    check(awkward(spark), slack=1.5)
    check(awkward(spark), capacity=7)


def test_empty_table(spark):
    assert pack_documents(empty(spark), PATH).collect() == []


def filled(plan, histogram, capacity):
    """Expand the plan; every rank of every length has one place."""
    used = defaultdict(list)
    seen = Counter()
    ends = {}
    for run in sorted(plan.runs):
        ends.setdefault(run[0], []).append(run)
    for length, count in histogram.items():
        runs = ends[length]
        firsts = [r[1] for r in runs]
        assert firsts[0] == 0
        for rank in range(count):
            run = runs[int(np.searchsorted(firsts, rank, side="right")) - 1]
            q, j = divmod(rank - run[1], run[2])
            used[run[3] + q].append((run[4] + j * length, length))
            seen[length] += 1
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def least_sequences(histogram, capacity):
    """A lower bound by dual feasible functions: a length counts for nothing if it is at
    most ``e``, for a whole sequence if it exceeds the rest, for its share otherwise."""
    best = 0
    for e in range(capacity // 2 + 1):
        weight = lambda k: capacity if k > capacity - e else 0 if k < e else k
        best = max(best, -(-sum(weight(k) * v for k, v in histogram.items()) // capacity))
    return best


def test_plans_are_gapless_and_tight():
    pick = random.Random(3)
    for capacity, top, n in ((4096, 1500, 5000), (4096, 4096, 3000), (64, 64, 500), (10, 10, 300), (1, 1, 5)):
        histogram = Counter(pick.randint(1, top) for _ in range(n))
        plain = Plan(capacity)
        for length in sorted(histogram, reverse=True):
            plain.best_fit(length, histogram[length])
        used = filled(make_plan(histogram, capacity), histogram, capacity)
        bound = least_sequences(histogram, capacity)
        assert bound <= used <= min(plain.sequences, 1 + 1.04 * bound)


def test_one_hot_length():
    histogram = {4096: 10_000, 1000: 1_000_000, 96: 50}
    plan = make_plan(histogram)
    assert plan.sequences <= 10_000 + 250_000 + 1 and len(plan.runs) < 100
    assert make_plan({}).sequences == 0


def test_patterns_and_fit():
    assert patterns(4, 2) == [(4,), (3, 1), (2, 2)]
    matrix = np.array([[1.0, 0, 2], [0, 1, 1]])
    assert np.allclose(matrix @ non_negative_fit(matrix, np.array([5.0, 2.0])), [5, 2])
    assert non_negative_fit(matrix, np.array([-1.0, 3.0])).min() >= 0


def test_mirrored_texts(spark):
    rows = [(i, t) for i, t in enumerate(mirrored())]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), slack=2)
