"""Quality by naive Bayes support vectors.

Indicators of token n-grams are scaled by the log-count ratio of the two classes, and a
linear hinge-loss model is fitted to them by dual coordinate descent. Tokens are words,
numbers and runs of signs as they are written; their shapes (case, digits, signs) give
n-grams of their own, which carry over to words never seen.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.chunks import cut_points
from patronage.llm.columns import id_remainder
from patronage.llm.logistic import calibrate, sigmoid
from patronage.llm.sampling import joined_sample
from patronage.llm.text import Block, Memo, blocks, kept, mix, segment_hashes

BITS = 18
SAMPLE_ROWS = 3000
_SPREAD = [np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) for k in range(1, 7)]


def shape(token: str) -> int:
    """A number for the form of a token: X for capitals, x for small letters, 9 for
    digits, other characters as they are; runs of one sign count at most twice."""
    out: list[str] = []
    for c in token:
        kind = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if out[-2:] != [kind, kind]:
            out.append(kind)
    return crc32("".join(out).encode("utf-8"))


def shapes(tokens: list[str]) -> np.ndarray:
    return np.array([shape(t) for t in tokens], dtype=np.int64).reshape(-1, 1)


def indicators(block: Block, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """(features, bounds): the distinct feature numbers of each row, in order."""
    starts = np.flatnonzero(cut_points(block))
    lengths = np.diff(np.append(starts, len(block.data)))
    token = segment_hashes(block.data, starts, lengths)
    form = memo.lookup(token, lambda i: block.text(starts[i], starts[i] + lengths[i]))[:, 0].view(np.uint64)
    row = block.rows_of(starts)
    keys = []

    def add(kind: int, value: np.ndarray, own: np.ndarray) -> None:
        number = mix(value + _SPREAD[kind]) >> np.uint64(64 - BITS)
        keys.append((own.astype(np.uint64) << np.uint64(BITS)) | number)

    same = row[1:] == row[:-1]
    add(0, token, row)
    add(1, (mix(token[:-1]) + token[1:])[same], row[1:][same])
    add(2, form, row)
    pair = mix(form[:-1]) + form[1:]
    add(3, pair[same], row[1:][same])
    if len(row) > 2:
        three = same[1:] & same[:-1]
        add(4, (mix(pair[:-1]) + form[2:])[three], row[2:][three])
    key = np.sort(np.concatenate(keys))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    bounds = np.searchsorted(key, np.arange(len(block) + 1, dtype=np.uint64) << np.uint64(BITS))
    return (key & np.uint64((1 << BITS) - 1)).astype(np.int64), bounds


@dataclass
class QualityModel:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        def sums(values):
            total = np.concatenate([[0.0], np.cumsum(values[features], dtype=np.float64)])
            return total[bounds[1:]] - total[bounds[:-1]]

        size = np.sqrt(sums(self.ratio**2))
        return sums(self.ratio * self.weight) / np.where(size > 0, size, 1) + self.bias

    def probabilities(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margins(features, bounds) + self.shift)


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    memo, found, ends = Memo(shapes, 1, np.int64), [], [np.zeros(1, np.int64)]
    for _, block in blocks(pa.array(texts, pa.string())):
        features, bounds = indicators(block, memo)
        found.append(features)
        ends.append(bounds[1:] + ends[-1][-1])
    return np.concatenate(found or [np.zeros(0, np.int64)]), np.concatenate(ends)


def log_count_ratio(features, bounds, labels, smoothing: float = 1.0) -> np.ndarray:
    own = np.repeat(labels, np.diff(bounds))
    logs = []
    for code in (1, 0):
        count = np.bincount(features[own == code], minlength=1 << BITS) + smoothing
        logs.append(np.log(count / count.sum()))
    ratio = logs[0] - logs[1]
    ratio[np.bincount(features, minlength=1 << BITS) == 0] = 0.0
    return ratio


def dual_coordinate_descent(rows, signs, size, cost: float, epochs: int, seed: int = 3):
    """Hinge loss with a bias feature of 1: ``rows`` are (features, values) pairs, signs
    1 or -1. Returns weights and bias."""
    weight, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    curve = np.array([v @ v + 1.0 for _, v in rows])
    upper = cost * np.where(signs > 0, len(signs) / max(1, 2 * (signs > 0).sum()), len(signs) / max(1, 2 * (signs < 0).sum()))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            features, values = rows[i]
            slope = signs[i] * (weight[features] @ values + bias) - 1
            new = min(max(alpha[i] - slope / curve[i], 0.0), upper[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weight[features] += step * values
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4 * cost:
            break
    return weight, bias


def fit(texts: list[str], labels: list[int], cost: float = 1.0, epochs: int = 15) -> QualityModel:
    """One text in five is left out of the fit and sets the scale of the scores."""
    label = np.array(labels, dtype=np.int64)
    if len(set(labels)) < 2:
        return QualityModel(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0)
    features, bounds = _features(texts)
    aside = np.arange(len(label)) % 5 == 0
    if len(set(label[aside].tolist())) < 2 or len(set(label[~aside].tolist())) < 2:
        aside[:] = False
    learn = np.flatnonzero(~aside)
    slices = [features[bounds[i] : bounds[i + 1]] for i in range(len(label))]
    own = [slices[i] for i in learn]
    ratio = log_count_ratio(
        np.concatenate(own), np.concatenate([[0], np.cumsum([len(s) for s in own])]), label[learn]
    )
    rows = []
    for s in own:
        values = ratio[s]
        rows.append((s, values / max(float(np.sqrt(values @ values)), 1e-9)))
    signs = np.where(label[learn] == 1, 1, -1)
    weight, bias = dual_coordinate_descent(rows, signs, 1 << BITS, cost, epochs)
    model = QualityModel(ratio, weight, bias)
    margins = model.margins(features, bounds)
    used = aside if aside.any() else ~aside
    model.slope, model.shift = calibrate(margins[used], label[used])
    return model


def _score(model):
    def run(batches):
        learned: QualityModel = model.value
        memo = kept("shapes", BITS, lambda: Memo(shapes, 1, np.int64))
        for batch in batches:
            found = []
            for _, block in blocks(batch.column(2)):
                found.append(learned.probabilities(*indicators(block, memo)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate(found or [np.zeros(0)]))],
                names=["doc_id", "held_out", "score"],
            )

    return run


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    modulus: int = 3,
    held_out_remainder: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (0 or 1).

    Learns from a sample of about ``rows`` labelled texts that are not held out by crc32
    of the id, as many of each label as there are; only the text makes a score. A text
    without tokens (null, empty) has the score of the bias alone. If there is nothing to
    learn from, every score is 0.5.
    """
    held_out = id_remainder(doc_id, modulus) == held_out_remainder
    sample = joined_sample(docs, labels.where(~held_out), label, text, doc_id, rows)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample["text"], sample["label"]))
    wanted = docs.select(
        F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text")
    )
    kind = wanted.schema["doc_id"].dataType.simpleString()
    scored = wanted.mapInArrow(_score(model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
