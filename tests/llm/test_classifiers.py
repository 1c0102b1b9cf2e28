from __future__ import annotations

import numpy as np
import pytest

from patronage.llm import quality, toxicity
from patronage.llm.logistic import calibrate, sigmoid
from patronage.llm.quality import dual_coordinate_descent, score_quality
from patronage.llm.toxicity import highest_windows, score_toxicity
from tests.llm.helpers import awkward, empty, remainder

BENCH = "/root/testdata/sf0.1"
CASES = [(score_toxicity, "toxic", 5, 0), (score_quality, "quality", 3, 1)]


def ranked(scores, labels):
    """Share of (1, 0) pairs in the right order."""
    order = np.argsort(scores)
    place = np.empty(len(order))
    place[order] = np.arange(len(order))
    ones = labels == 1
    n = ones.sum()
    return (place[ones].sum() - n * (n - 1) / 2) / (n * (len(labels) - n))


@pytest.mark.parametrize("score, label, modulus, rest, least", [(*c, a) for c, a in zip(CASES, (0.93, 0.99))])
def test_held_out_accuracy(spark, score, label, modulus, rest, least):
    docs = spark.read.parquet(f"{BENCH}/documents.parquet")
    labels = spark.read.parquet(f"{BENCH}/labels.parquet")
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (remainder(r.doc_id, modulus) == rest) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    scores, wanted = map(np.array, zip(*held))
    assert ranked(scores, wanted) > least
    assert ((scores >= 0.5) == wanted).mean() > 0.95


@pytest.mark.parametrize("score, label, modulus, rest", CASES)
def test_awkward_rows(spark, score, label, modulus, rest):
    docs = awkward(spark)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(1, 13)] + [(1, 1), (None, 1), (2, None)], f"doc_id bigint, {label} int"
    )
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    assert [r.score for r in score(docs, labels.limit(0)).collect()] == [0.5] * len(rows)
    assert score(empty(spark), labels).collect() == []


def test_misspelling_shares_subwords():
    clean = [f"plain words number {i} about nothing much" for i in range(60)]
    bad = [f"plain words number {i} you wretched nitwit there" for i in range(60)]
    model = toxicity.fit(clean + bad, [0] * 60 + [1] * 60)
    seen, misspelt, other = model.word_scores(["nitwit", "nittwit", "harbour"])[:, 0]
    assert seen > misspelt > other


def test_highest_windows_match_a_loop():
    rng = np.random.default_rng(4)
    bounds = np.array([0, 0, 1, 3, 10, 10, 31])
    scores = rng.normal(size=31)
    for window in (1, 2, 5):
        best, first = highest_windows(scores, bounds, window)
        for row in range(6):
            own = scores[bounds[row] : bounds[row + 1]]
            spans = [own[i : i + window].mean() for i in range(len(own) - window + 1)]
            want = max(spans) if spans else own.mean() if len(own) else 0
            assert abs(best[row] - want) < 1e-12
            assert bounds[row] <= first[row] <= bounds[row + 1]


def test_coordinate_descent_reaches_the_optimum():
    """The primal and the dual objective meet."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 8))
    signs = np.where(x[:, 0] + 0.5 * rng.normal(size=60) > 0, 1, -1)
    rows = [(np.arange(8), v) for v in x]
    weight, bias = dual_coordinate_descent(rows, signs, 8, 1.0, 2000)
    cost = np.where(signs > 0, 60 / (2 * (signs > 0).sum()), 60 / (2 * (signs < 0).sum()))

    def primal(w, b):
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - signs * (x @ w + b))).sum()

    best = primal(weight, bias)
    for _ in range(200):
        assert primal(weight + 0.02 * rng.normal(size=8), bias + 0.02 * rng.normal()) >= best - 1e-3


def test_ratio_and_shapes():
    ratio = quality.log_count_ratio(np.array([1, 2, 2]), np.array([0, 2, 3]), np.array([1, 0]))
    assert ratio[1] > 0 > ratio[2] and ratio[5] == 0
    assert quality.shape(" Abc") == quality.shape(" Xyzzy") != quality.shape(" ABC")


def test_calibration():
    margins = np.array([-3.0, -2, -1, 1, 2, 3])
    slope, shift = calibrate(margins, np.array([0, 0, 0, 1, 1, 1]))
    assert ((sigmoid(slope * margins + shift) > 0.5) == (margins > 0)).all()
    assert calibrate(margins, np.ones(6)) == (1.0, 0.0)
