"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of 1 to ``orders`` characters of every lower-cased word with its edges marked.
The log-probability matrix is broadcast; each distinct word of a block is turned into
one row of log-likelihoods, and a document is the sum over its words.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.columns import id_remainder
from patronage.llm.sampling import labelled_sample
from patronage.llm.text import Memo, Words, blocks, kept, row_sums, segment_hashes

BUCKETS = 1 << 15
ORDERS = 4
UNKNOWN = "und"


def ngram_buckets(words: list[str], orders: int = ORDERS, buckets: int = BUCKETS):
    """Bucket numbers of the n-grams of all words, and for each the index of its word."""
    data = np.frombuffer("".join(f"<{word}>" for word in words).encode("utf-8"), dtype=np.uint8)
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # first bytes of characters
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))  # characters to the end of the word
    grams, owners = [], []
    for n in range(1, orders + 1):
        first = np.flatnonzero(left >= n)
        hashes = segment_hashes(data, at[first], at[first + n] - at[first])
        grams.append((hashes % np.uint64(buckets)).astype(np.int64))
        owners.append(owner[first])
    return np.concatenate(grams), np.concatenate(owners)


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray  # buckets x languages, float32

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Per word: log-likelihood by language, then whether it holds a letter."""
        out = np.zeros((len(words), len(self.languages) + 1))
        for low in range(0, len(words), 20_000):  # bounds the table of n-grams
            part = words[low : low + 20_000]
            grams, owners = ngram_buckets(part)
            for code in range(len(self.languages)):
                likelihoods = self.log_probability[grams, code].astype(np.float64)
                out[low : low + len(part), code] = np.bincount(owners, likelihoods, len(part))
        out[:, -1] = [any(map(str.isalpha, word)) for word in words]
        return out


def fit(texts: list[str], languages: list[str], smoothing: float = 0.5) -> LanguageModel:
    names = sorted(set(languages))
    number = {name: i for i, name in enumerate(names)}
    counts = np.zeros((BUCKETS, len(names)))
    column = np.array([number[name] for name in languages], dtype=np.int64)
    for row, block in blocks(pa.array(texts, pa.string())):
        words = Words(block)
        label = column[row + words.rows()]
        for code in range(len(names)):
            own = np.flatnonzero(label == code)
            _, first, times = np.unique(words.hashes[own], return_index=True, return_counts=True)
            if len(first):
                grams, owners = ngram_buckets([words.text(i) for i in own[first].tolist()])
                counts[:, code] += np.bincount(grams, times[owners].astype(np.float64), BUCKETS)
    shown = np.bincount(column, minlength=len(names)) if len(names) else np.zeros(0)
    return LanguageModel(
        names,
        np.log(shown / max(1, shown.sum())) if len(names) else shown,
        np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * BUCKETS)).astype(np.float32),
    )


def train(
    docs: DataFrame, label: str = "lang", text: str = "text", doc_id: str = "doc_id", rows: int = 4000
) -> LanguageModel:
    """Fit on a bounded sample of labelled rows: about ``rows`` whole texts, the same
    number per language. ``docs`` should hold the training rows only."""
    sample = labelled_sample(docs, label, text, doc_id, rows)
    return fit(sample["text"], sample["label"])


def _predict(model, token: str):
    def run(batches):
        learned: LanguageModel = model.value
        n = len(learned.languages)
        memo = kept("language", token, lambda: Memo(learned.word_rows, n + 1, np.float64))
        names = np.array([*learned.languages, UNKNOWN], dtype=object)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found, scores = [], []
            for _, block in blocks(texts):
                words = Words(block)
                sums = row_sums(memo.lookup(words.hashes, words.text), words.bounds)
                best = np.full(len(block), n)
                score = np.zeros(len(block))
                lettered = np.flatnonzero(sums[:, n] > 0)
                if n and len(lettered):
                    total = sums[lettered, :n] + learned.log_prior
                    best[lettered] = total.argmax(axis=1)
                    odds = np.exp(total - total.max(axis=1, keepdims=True))
                    score[lettered] = 1 / odds.sum(axis=1)
                found += names[best].tolist()
                scores += score.tolist()
            passed = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*passed, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return run


def _predicted(rows: DataFrame, model: LanguageModel) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(_predict(sent, uuid4().hex), T.StructType([*rows.schema.fields, *added]))


def identify_language(
    docs: DataFrame,
    train_docs: DataFrame | None = None,
    modulus: int = 3,
    held_out_remainder: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    rows: int = 4000,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (posterior probability).

    Learns from rows of ``train_docs`` (default: ``docs``) with text and label that are
    not held out by crc32 of the id. Text that is null or without any letter gets
    ``und`` and score 0, and so does every text when there is nothing to learn from.
    Equal scores go to the language first in order of code points.
    """
    held_out = id_remainder(doc_id, modulus) == held_out_remainder
    model = train((docs if train_docs is None else train_docs).where(~held_out), label, text, doc_id, rows)
    wanted = docs.select(
        F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text")
    )
    return _predicted(wanted, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(
    docs: DataFrame, min_score: float = 0.5, doc_id: str = "doc_id", text: str = "text", label: str = "lang"
) -> DataFrame:
    """The rows whose language is found with a score of at least ``min_score``; rows
    without a letter go. Trained like ``identify_language``; all columns stay as they are."""
    model = train(docs.where(id_remainder(doc_id, 3) != 1), label, text, doc_id)
    others = [c for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(*[F.col(c) for c in others], F.lit(0).alias("_")).alias("row"),
        F.col(text).alias("text"),
    )
    kept = _predicted(rows, model).where(
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)
    )
    return kept.select(
        *[(F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns]
    )
