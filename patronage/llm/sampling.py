"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fitting uses whole texts; a labelled row with a longer text is not used for fitting.
MAX_CHARS = 50_000
SPAN = 1 << 30


def _share(frame: DataFrame, rows: int, place) -> DataFrame:
    """About ``rows`` rows of (label, ...), as equal in number per label as there are."""
    counts = {r["label"]: r["count"] for r in frame.groupBy("label").count().collect()}
    wanted = F.lit(False)
    for name, count in counts.items():
        top = min(SPAN, int(SPAN * rows / len(counts) / count))
        wanted = wanted | ((F.col("label") == F.lit(name)) & (place < top))
    return frame.where(wanted)


def _collected(frame: DataFrame, place) -> dict[str, list]:
    taken: pa.Table = frame.select("label", "text", place.alias("place")).toArrow()
    taken = taken.sort_by([("place", "ascending"), ("text", "ascending")])
    return {"label": taken["label"].to_pylist(), "text": taken["text"].to_pylist()}


def labelled_sample(
    docs: DataFrame, label: str, text: str, doc_id: str, rows: int, max_chars: int = MAX_CHARS
) -> dict[str, list]:
    """About ``rows`` rows with text and label, for labels that stand beside the text.

    Rows are taken by a hash of the id and the text, so the sample does not depend on
    how the table is partitioned. Its size has a fixed bound whatever the table holds:
    ``rows`` texts of at most ``max_chars`` characters reach the driver. There are few
    labels; each is counted once here.
    """
    usable = docs.where(
        F.col(label).isNotNull() & F.col(text).isNotNull() & (F.char_length(text) <= max_chars)
    ).select(F.col(label).alias("label"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SPAN))
    return _collected(_share(usable, rows, place), place)


def joined_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    text: str,
    doc_id: str,
    rows: int,
    max_chars: int = MAX_CHARS,
) -> dict[str, list]:
    """The same for labels in a table of their own, keyed by ``doc_id``.

    Label rows are sampled first, which bounds what is broadcast to the scan of the
    texts. An id with several labels counts once, with the highest. Rows without a label
    or without an id are not used.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(SPAN))
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.max(label).alias("label"))
    )
    chosen = _share(known, rows, place)
    texts = docs.where(F.col(text).isNotNull() & (F.char_length(text) <= max_chars)).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    return _collected(texts.join(F.broadcast(chosen), "doc_id"), place)
