"""Toxicity by subword embeddings: averaged vectors and a linear softmax, trained together.

A word is the mean of the vectors of its character n-grams and of itself, all hashed
into one table, so a misspelling shares most of its vector. Vectors are averaged over a
window of words, and the window that scores highest speaks for its document: a few
words decide in a text of any length. With two classes the softmax is one direction, so
each word comes down to one number when texts are scored.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.columns import id_remainder
from patronage.llm.logistic import calibrate, sigmoid
from patronage.llm.sampling import joined_sample
from patronage.llm.text import Memo, Words, blocks, kept

BUCKETS = 1 << 17
DIMENSION = 10
WINDOW = 2
SAMPLE_ROWS = 4000


def subwords(word: str) -> list[int]:
    marked = f"<{word}>"
    grams = [marked[i : i + n] for n in (3, 4, 5, 6) for i in range(len(marked) - n + 1)]
    return [crc32(g.encode("utf-8")) % BUCKETS for g in (*grams, f"={word}")]


@dataclass
class ToxicityModel:
    bucket_scores: np.ndarray  # embedding of each bucket along the softmax direction
    slope: float
    shift: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        return np.array([self.bucket_scores[subwords(w)].mean() for w in words]).reshape(-1, 1)

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margins + self.shift)


def highest_windows(scores: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Per row: the highest mean over ``window`` neighbouring words (all words, if there
    are fewer; 0 without words), and the first word of that window."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    counts = np.diff(bounds)
    best, first = np.zeros(len(counts)), bounds[:-1].copy()
    short = (counts > 0) & (counts <= window)
    best[short] = (total[bounds[1:]] - total[bounds[:-1]])[short] / counts[short]
    long = np.flatnonzero(counts > window)
    if len(long):
        mean = (total[window:] - total[:-window]) / window
        for row in long.tolist():
            own = mean[bounds[row] : bounds[row + 1] - window + 1]
            at = int(own.argmax())
            best[row], first[row] = own[at], bounds[row] + at
    return best, first


class _Training:
    """Words of the sample by number, and the subwords of every distinct word."""

    def __init__(self, texts: list[str]):
        names: dict[str, int] = {}
        numbers, counts = [], []
        for _, block in blocks(pa.array(texts, pa.string())):
            words = Words(block)
            unique, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
            known = [names.setdefault(words.text(i), len(names)) for i in first.tolist()]
            numbers.append(np.array(known, dtype=np.int64)[inverse])
            counts.append(words.counts())
        self.words = np.concatenate(numbers or [np.zeros(0, np.int64)])
        self.bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts or [[]]))]).astype(np.int64)
        parts = [np.array(subwords(w), dtype=np.int32) for w in names]
        self.sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.subwords = np.concatenate(parts or [np.zeros(0, np.int32)])

    def word_scores(self, bucket_scores: np.ndarray) -> np.ndarray:
        if not len(self.sizes):
            return np.zeros(0)
        return np.add.reduceat(bucket_scores[self.subwords], self.first) / self.sizes


def fit(texts: list[str], labels: list[int], epochs: int = 8, rate: float = 0.5, seed: int = 7) -> ToxicityModel:
    data, label = _Training(texts), np.array(labels)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSION))
    direction = rng.normal(0, 1, DIMENSION)
    bias, seen, seen_direction = 0.0, np.full(BUCKETS, 1e-6), np.full(DIMENSION, 1e-6)
    counts = np.diff(data.bounds)
    usable = np.flatnonzero(counts > 0)
    if not len(usable) or len(set(labels)) < 2:
        return ToxicityModel(np.zeros(BUCKETS), 1.0, 0.0)
    for epoch in range(epochs):
        scores = data.word_scores(table @ direction)
        _, top = highest_windows(scores[data.words], data.bounds)
        # Where each example begins: the highest window and random ones; at first, many
        # of both classes, later only the highest of a toxic text.
        extra = 6 if epoch == 0 else 2
        rows = np.repeat(usable, extra)
        spots = data.bounds[rows] + (rng.random(len(rows)) * np.maximum(1, counts[rows] - WINDOW + 1)).astype(np.int64)
        if epoch:
            clean = label[rows] == 0
            rows, spots = np.concatenate([rows[clean], usable]), np.concatenate([spots[clean], top[usable]])
        share = label[rows].mean()
        weight = np.where(label[rows] == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
        order = rng.permutation(len(rows))
        for batch in np.array_split(order, max(1, len(order) // 128)):
            row, spot = rows[batch], spots[batch]
            size = np.minimum(counts[row], WINDOW)
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) + np.repeat(spot - (ends - size), size)
            word = data.words[at]
            parts = data.sizes[word]
            last = np.cumsum(parts)
            sub = data.subwords[np.arange(last[-1]) + np.repeat(data.first[word] - (last - parts), parts)]
            share_of = np.repeat(1.0 / (np.repeat(size, size) * parts), parts)
            owner = np.repeat(np.repeat(np.arange(len(batch)), size), parts)
            logit = np.bincount(owner, share_of * (table @ direction)[sub], len(batch)) + bias
            error = weight[batch] * (sigmoid(logit) - label[row]) / len(batch)
            pull = np.bincount(sub, share_of * error[owner], BUCKETS)
            touched = np.flatnonzero(pull)
            slope = table[touched].T @ pull[touched]
            seen[touched] += (pull[touched] ** 2) * (direction @ direction)
            seen_direction += slope**2
            table[touched] -= rate * np.outer(pull[touched] / np.sqrt(seen[touched]), direction)
            direction -= 0.1 * rate * slope / np.sqrt(seen_direction)
            bias -= rate * error.sum()
    scores = table @ direction
    margins, _ = highest_windows(data.word_scores(scores)[data.words], data.bounds)
    slope, shift = calibrate(margins, label)
    return ToxicityModel(scores, slope, shift)


def _score(model, token: str):
    def run(batches):
        learned: ToxicityModel = model.value
        memo = kept("toxicity", token, lambda: Memo(learned.word_scores, 1, np.float64))
        for batch in batches:
            found = []
            for _, block in blocks(batch.column(2)):
                words = Words(block)
                scores = memo.lookup(words.hashes, words.text)[:, 0]
                found.append(learned.probabilities(highest_windows(scores, words.bounds)[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate(found or [np.zeros(0)]))],
                names=["doc_id", "held_out", "score"],
            )

    return run


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    modulus: int = 5,
    held_out_remainder: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (0 or 1).

    Learns from a sample of about ``rows`` labelled texts that are not held out by crc32
    of the id, as many of each label as there are; only the text makes a score. A text
    without words (null, empty) scores as a window of mean 0. If there is nothing to
    learn from, every score is 0.5.
    """
    held_out = id_remainder(doc_id, modulus) == held_out_remainder
    sample = joined_sample(docs, labels.where(~held_out), label, text, doc_id, rows)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample["text"], sample["label"]))
    wanted = docs.select(
        F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text")
    )
    kind = wanted.schema["doc_id"].dataType.simpleString()
    scored = wanted.mapInArrow(_score(model, uuid4().hex), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
