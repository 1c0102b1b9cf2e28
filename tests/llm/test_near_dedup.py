from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from patronage.llm.buckets import near_labels
from patronage.llm.components import components
from patronage.llm.near_dedup import BANDS, ROWS, _signatures, near_dedup, near_groups, prob_min_hash, similarities
from tests.llm.helpers import awkward, empty, words


def bag(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def probability_jaccard(a, b):
    m, n = sum(a.values()), sum(b.values())
    p, q = {k: v / m for k, v in a.items()}, {k: v / n for k, v in b.items()}
    every = p.keys() | q.keys()
    return sum(
        1 / sum(max(p.get(e, 0) / p[d], q.get(e, 0) / q[d]) for e in every) for d in p.keys() & q.keys()
    )


def near(a, b):
    plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    if plain >= 0.8:
        return True
    if plain < 0.3:
        return False
    return probability_jaccard(a, b) >= 0.8


def brute(docs):
    """Class (least id) of every document, by comparing all pairs that share a shingle."""
    bags = {i: bag(t) for i, t in docs}
    holders = defaultdict(list)
    for i, b in bags.items():
        for shingle in b:
            holders[shingle].append(i)
    shared = Counter()
    for ids in holders.values():
        ids.sort()
        shared.update((x, y) for k, x in enumerate(ids) for y in ids[k + 1 :])
    top = {i: i for i in bags}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for (x, y), n in shared.items():
        if 4 * n >= min(len(bags[x]), len(bags[y])) and near(bags[x], bags[y]):
            x, y = find(x), find(y)
            top[max(x, y)] = min(x, y)
    return {i: find(i) for i in bags}


@pytest.fixture(scope="module")
def small_rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]


def test_classes_match_all_pairs(spark, small_rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute(small_rows)
    rows = near_groups(docs).collect()
    assert {r.doc_id: r.class_id for r in rows} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in rows)
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())


def edited(pick, base, n):
    out = list(base)
    for _ in range(n):
        out[pick.randrange(len(out))] = f"new{pick.randrange(10**9)}"
    return " ".join(out)


def test_chains_and_large_groups(spark):
    """A long chain of small edits, a large group of near copies, and texts that share
    half their words with many others."""
    pick = random.Random(5)
    rows, base = [], [f"w{i}" for i in range(120)]
    for i in range(40):  # neighbours are near, the ends are not
        rows.append((i, " ".join(base)))
        base = edited(pick, base, 2).split()
    group = [f"g{i}" for i in range(150)]
    rows += [(100 + i, edited(pick, group, pick.randrange(3))) for i in range(200)]
    common = [f"c{i}" for i in range(60)]
    rows += [(400 + i, " ".join(common + [f"u{i}x{j}" for j in range(60)])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert {r.doc_id: r.class_id for r in near_groups(docs).collect()} == brute(rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = near_groups(docs).collect()
    assert len(rows) == docs.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert {r.class_id for i in (1, 2) for r in by_id[i]} == {1}
    assert [by_id[i][0].class_size for i in (1, 3, 4, 5)] == [3, 1, 1, 1]
    assert by_id[None][0].class_id is None and by_id[None][0].kept
    kept = near_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert near_groups(empty(spark)).collect() == [] and near_dedup(empty(spark)).collect() == []


def test_slots_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    own = np.sort(rng.integers(1, 2**63, 300, dtype=np.uint64))
    a, b = own[:200], own[50:]
    m, n = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(b))
    slots = 4000
    both = prob_min_hash(
        np.concatenate([a, b]), np.concatenate([m, n]).astype(float), np.array([0, len(a), len(a) + len(b)]), slots
    )
    want = probability_jaccard(dict(zip(a.tolist(), m.tolist())), dict(zip(b.tolist(), n.tolist())))
    assert abs((both[0] == both[1]).mean() - want) < 0.035
    assert abs(similarities((a, m), (b, n))[0] - want) < 1e-9


def test_components(spark):
    pick = random.Random(2)
    links = [(f"n{pick.randrange(60):03}", f"n{pick.randrange(60):03}") for _ in range(40)]
    links += [(f"p{i:03}", f"p{i + 1:03}") for i in range(50)] + [("h", f"h{i:03}") for i in range(300)] + [(None, "x")]
    top = {}
    find = lambda i: i if top.setdefault(i, i) == i else find(top[i])
    for a, b in links:
        if a is not None:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a string, b string")).collect()
    assert {r.node: r.label for r in got} == {i: find(i) for i in top}
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []


def test_large_star_group_is_one_class(spark):
    """1,500 forms of one text, near the text but not each other."""
    pick = random.Random(6)
    base = [f"s{i}" for i in range(304)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1500):
        own = list(base)
        for k in pick.sample(range(10, 280, 26), 6):  # apart: each changes five shingles
            own[k + pick.randrange(20)] = f"e{i}x{k}"
        rows.append((i, " ".join(own)))
    one, two = bag(rows[0][1]), bag(rows[1][1])
    assert len(one.keys() & two.keys()) / len(one.keys() | two.keys()) >= 0.8
    two, three = (bag(t) for _, t in rows[1:3])
    assert len(two.keys() & three.keys()) / len(two.keys() | three.keys()) < 0.8
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    sizes = Counter(r.class_id for r in near_groups(docs).collect())
    # A form is missed by all bands once in 300,000 times.
    assert len(sizes) == 1


def test_full_comparison_of_a_block():
    """Labels that the blocks join are those of all pairs, by either similarity."""
    rng = np.random.default_rng(4)
    base = rng.integers(1, 2**63, 60, dtype=np.uint64)
    bags = []
    for k in range(50):
        own = base.copy()
        own[rng.choice(60, 5, replace=False)] = rng.integers(1, 2**63, 5, dtype=np.uint64)
        counts = np.ones(60, dtype=np.int64)
        counts[:6] = 1 + 30 * (k % 2)
        bags.append((own, counts))
    side = np.array([1] * 25 + [2] * 25)
    own, counts = (np.concatenate(x) for x in zip(*bags))
    links = near_labels(own, counts, np.full(50, 60), np.arange(50), side, 0.8, lambda a, b: similarities(a, b)[0])
    assert all(max(similarities(bags[a], bags[b])) >= 0.8 for a, b in links)
    got, want = list(range(50)), list(range(50))
    pairs = [(a, b) for a in range(25) for b in range(25, 50) if max(similarities(bags[a], bags[b])) >= 0.8]
    for top, found in ((got, links), (want, pairs)):
        for a, b in found:
            a, b = top[a], top[b]
            top[:] = [min(a, b) if t in (a, b) else t for t in top]
    assert got == want and len(set(want)) < 50


def test_repeated_lines_keep_a_plain_candidate():
    """Equal shingles but for a passage repeated in one copy: plain Jaccard is high,
    probability Jaccard low. Almost all pairs must still share a bucket."""
    pick = random.Random(3)
    texts, pairs = [], 200
    for k in range(pairs):
        line = [f"l{k}x{pick.randrange(10**6)}" for _ in range(30)]
        rest = [f"r{k}x{i}" for i in range(270)]
        texts += [" ".join(rest + line), " ".join(rest + line * 21)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([str(i) for i in range(len(texts))]), pa.array(range(len(texts))), pa.array(texts)],
        names=["id", "tie", "text"],
    )
    one, two = bag(texts[0]), bag(texts[1])
    assert near(one, two) and probability_jaccard(one, two) < 0.5
    buckets = [set(b) for out in _signatures(BANDS, ROWS)([batch]) for b in out.column(4).to_pylist()]
    assert all(buckets[2 * k] & buckets[2 * k + 1] for k in range(pairs))
    assert all(len(b) == BANDS for b in buckets[::2])


def test_bands_find_a_pair_at_the_limit():
    """Chance that a pair of similarity 0.8 shares no band."""
    assert (1 - 0.8**ROWS) ** BANDS < 1 / 150_000
