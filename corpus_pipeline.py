"""From raw documents to packed training sequences.

Every stage reads all rows that the one before kept and decides for each whole text. All
but the last return rows of ``documents`` with unchanged columns. Empty tables pass
through every stage; a null text has no letter and leaves with the first.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from patronage.llm.columns import table
from patronage.llm.decontaminate import drop_contaminated
from patronage.llm.exact_dedup import exact_dedup
from patronage.llm.language_id import keep_identified
from patronage.llm.near_dedup import near_dedup
from patronage.llm.packing import pack_documents
from patronage.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised; those without a letter go."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", benchmark),
    ("packing", pack),
]

# Language, near-duplicate and packing stages cannot be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what passes between them is written and read again."""
    rows = table(spark, sf_dir, "documents")
    for number, (name, apply) in enumerate(STAGES):
        rows = apply(spark, stage(rows, name) if number else rows, sf_dir)
    return rows
