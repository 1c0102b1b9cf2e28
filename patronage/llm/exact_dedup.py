"""Exact deduplication with DataFrame functions only.

Texts are equal when they agree after white space is deleted. Rows are grouped by the
128-bit hash of that normal form together with its bytes, so rows with equal hashes
and different bytes fall apart inside the aggregation. The partial aggregate leaves
one row per text and task, which takes the weight off large groups before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.columns import BLANKS, whole_text


def normal_form(text: str) -> Column:
    return F.regexp_replace(whole_text(text), BLANKS, "")


def _order(doc_id: str, text: str, tie: Column) -> Column:
    """Least first: longest original text, smallest id (null last), then the tie value."""
    return F.struct(
        (-F.char_length(whole_text(text))).alias("length"),
        F.col(doc_id).isNull().alias("no_id"),
        F.col(doc_id).alias("id"),
        tie.alias("tie"),
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text stays, then
    the smallest id; a null id loses to any other. Null text counts as empty, and empty
    texts equal each other. Rows that agree in id and text are told apart only by
    number: one of them can be kept. Other columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        normal_form(text).alias("normal"),
        _order(doc_id, text, F.xxhash64(whole_text(text))).alias("place"),
    ).withColumn("content", F.md5(F.col("normal").cast("binary")))
    groups = (
        rows.groupBy("content", "normal")
        .agg(F.min("place").alias("best"), F.count("*").alias("group_size"))
        .select("content", F.sha2("normal", 256).alias("text_sha256"), "best", "group_size")
    )
    members = (
        rows.select("content", F.sha2("normal", 256).alias("text_sha256"), "doc_id", "place")
        .groupBy("content", "text_sha256", "doc_id", "place")
        .agg(F.count("*").alias("copies"))
    )
    return (
        members.join(groups, ["content", "text_sha256"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
        .select(
            "doc_id",
            F.col("best.id").alias("keep_id"),
            "group_size",
            ((F.col("place") == F.col("best")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; the same rule as ``exact_groups``.

    Rows of equal id and text that differ in other columns are ordered by a hash of the
    whole row. Whole rows ride through the aggregation, so no join is needed and a group
    of any size leaves each task as one row.
    """
    # The whole row is one struct, so no name of a caller's column can clash.
    place = _order(doc_id, text, F.xxhash64(*[F.col(c) for c in docs.columns]))
    whole = F.struct(*[F.col(c) for c in docs.columns])
    rows = docs.select(
        normal_form(text).alias("normal"), F.struct(place.alias("place"), whole.alias("row")).alias("best")
    ).withColumn("content", F.md5(F.col("normal").cast("binary")))
    kept = rows.groupBy("content", "normal").agg(F.min_by("best", "best.place").alias("best"))
    return kept.select("best.row.*")
