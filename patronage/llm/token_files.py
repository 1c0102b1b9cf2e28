"""Token ids as Parquet lists, in id order, with the metadata beside them.

Files hold: part, doc_id, n_tokens, part_start, ids. Token lists are dictionary-encoded,
the sorted numbers delta-encoded; row groups and pages are small and pages are indexed,
so that a reader of one document, or of the metadata alone, reads little else.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.chunks import with_end, worker_encoder
from patronage.llm.columns import shuffle_partitions
from patronage.llm.text import blocks
from patronage.session import scratch_root

LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",  # delta encoding where no dictionary is kept
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
}


def _encode(tokenizer, end: int):
    def run(batches):
        encoder = worker_encoder(tokenizer.value)
        start = 0
        for batch in batches:
            sent = 0
            for row, block in blocks(batch.column(1)):
                ids, bounds = with_end(*encoder.encode(block), end)
                starts = start + bounds[:-1]
                start += int(bounds[-1])
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(block)),
                        pa.array(np.diff(bounds)),
                        pa.array(starts),
                        lists,
                    ],
                    names=["doc_id", "n_tokens", "part_start", "ids"],
                )
                sent += len(block)

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Tokenize whole texts and write them in ascending id order (null ids first, rows of
    equal id by a hash of the text). Null text counts as empty and gives the end id only.
    Special strings inside texts are handled as the library does by default.

    The text is dealt by ranges of the id before it is tokenized, so ids are made once
    and never shuffled. Other columns are not read. ``tokenizer_path`` is read on the
    driver.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie")
    )
    key = [F.col("doc_id").asc_nulls_first(), "tie"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *key).sortWithinPartitions(*key)
    encoded = dealt.select("doc_id", "text").mapInArrow(
        _encode(tokenizer, end), f"doc_id {kind}, n_tokens bigint, part_start bigint, ids array<int>"
    )
    encoded.select(F.spark_partition_id().alias("part"), "*").write.options(**LAYOUT).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids; what is not selected
    is not read. Starts come from one row per file part."""
    rows = spark.read.parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    # One row per part: there are as many as shuffle partitions.
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids"
    )


def _checksums(batches):
    for batch in batches:
        lists = batch.column(3)
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        raw = memoryview(ids.tobytes())
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, from the files alone."""
    rows = read_token_files(spark, path)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _checksums, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_round_trip(docs: DataFrame, tokenizer_path: str, end: int = 0, **names) -> DataFrame:
    """Write the files to a new path in the shared folder and digest what is read back."""
    spark = docs.sparkSession
    path = f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer_path, end, **names)
    return token_file_digest(spark, path)
