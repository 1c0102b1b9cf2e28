"""Repeated byte strings by a distributed suffix array.

The suffixes at anchors (``suffixes``) stand for all windows of ``span`` bytes. A sample
of them, drawn over all texts, gives splitters; suffixes are dealt to buckets by the range
of their leading bytes, and each bucket sorts its own by multikey quicksort, forwards from
the anchor and backwards before it. Windows are equal if they lie in one run of both
orders, and a window is repeated if a text of smaller id is in its run.

A run that reaches a splitter may go on in other buckets. Of its windows each bucket
hands on the first text only, and these few rows are compared across the boundaries. So a
string that a third of all rows hold is dealt over many buckets and costs each boundary
one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.columns import shuffle_partitions
from patronage.llm.suffixes import (
    Records,
    anchored,
    characters,
    common_prefixes,
    joined,
    left_parts,
    multikey_order,
    right_parts,
    shared_with,
    sort_keys,
)
from patronage.llm.text import blocks, mix
from patronage.session import stage

SPAN = 50
BUCKET_BYTES = 20 << 20  # bytes of records that one bucket should hold
PACK_BYTES = 8 << 20  # bytes of text whose records go out together
NOBODY = -(1 << 63)  # the place of a missing id in the order of ids
_FOUND = "owner bigint, name bigint, starts array<bigint>, ends array<bigint>, window binary"


def _records(batches, span: int):
    """(owners, names, records) of about PACK_BYTES of text at a time; ``records.row``
    counts in the two arrays. Batches hold owner, name, text; of repeated rows within the
    same bytes only the first gives records."""
    owners, names, parts, size, rows, seen = [], [], [], 0, 0, set()
    for batch in batches:
        owner, name = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for first, block in blocks(batch.column(2)):
            own = slice(first, first + len(block))
            fresh = np.ones(len(block), dtype=bool)
            for i, pair in enumerate(zip(owner[own].tolist(), name[own].tolist())):
                fresh[i] = pair not in seen
                seen.add(pair)
            for records in anchored(block, span):
                if not fresh.all():
                    records = records.take(np.flatnonzero(fresh[records.row]), span)
                records.row += rows
                parts.append(records)
            owners.append(owner[own])
            names.append(name[own])
            rows += len(block)
            size += len(block.data)
            if size >= PACK_BYTES:
                if parts:
                    yield np.concatenate(owners), np.concatenate(names), joined(parts)
                owners, names, parts, size, rows, seen = [], [], [], 0, 0, set()
    if parts:
        yield np.concatenate(owners), np.concatenate(names), joined(parts)


def _keys(owners: np.ndarray, records: Records, span: int) -> np.ndarray:
    return sort_keys(right_parts(records, span), owners[records.row], records.start)


def _sample(span: int, share: float):
    """Keys of a share of the records, chosen by a hash of owner and place."""
    top = np.uint64(min(share, 1.0) * ((1 << 64) - 2048))

    def run(batches):
        for owners, _, records in _records(batches, span):
            mark = mix(owners[records.row].astype(np.int64).view(np.uint64) + mix(records.start.astype(np.uint64)))
            chosen = np.flatnonzero(mark <= top)
            keys = _keys(owners, records.take(chosen, span), span)
            yield pa.RecordBatch.from_arrays([pa.array(keys.tolist(), pa.binary())], names=["key"])

    return run


def splitters(rows: DataFrame, span: int, buckets: int, total_bytes: int) -> np.ndarray:
    """At most ``buckets`` - 1 keys that cut the suffixes into parts of like size. The
    sample has some 8 to 64 keys per bucket, about a million at most."""
    per_bucket = min(64, max(8, (1 << 20) // buckets))
    expected = max(1.0, total_bytes / ((span - 7) / 2))
    sampled = rows.mapInArrow(_sample(span, per_bucket * buckets / expected), "key binary").toArrow()
    width = -(-span // 8) * 8 + 16
    keys = np.sort(np.array(sampled["key"].to_pylist(), dtype=f"S{width}"))
    if not len(keys):
        return keys
    return np.unique(keys[(np.arange(1, buckets) * len(keys)) // buckets])


def _packed(owners: np.ndarray, names: np.ndarray, records: Records) -> bytes:
    """One bucket's share of some texts. Numbers are stored by planes of equal bytes."""
    used, row = np.unique(records.row, return_inverse=True)
    planes = [
        np.array([len(used), len(records), len(records.data)], dtype="<i8").view(np.uint8),
        owners[used].astype("<i8").view(np.uint8).reshape(-1, 8).T.ravel(),
        names[used].astype("<i8").view(np.uint8),
        np.diff(row, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T.ravel(),
        records.start.astype("<i8").view(np.uint8).reshape(-1, 8).T.ravel(),
        records.left,
        records.count,
        records.data,
    ]
    return zstandard.ZstdCompressor(level=3).compress(np.concatenate(planes).tobytes())


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray, Records]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    texts, n, size = raw[:24].view("<i8").tolist()
    at = 24

    def part(length: int, width: int, kind: str | None) -> np.ndarray:
        nonlocal at
        piece = raw[at : at + length * width]
        at += length * width
        return np.ascontiguousarray(piece.reshape(width, length).T).ravel().view(kind) if kind else piece

    owners = part(texts, 8, "<i8")
    names = np.ascontiguousarray(part(texts, 8, None)).view("<i8")
    row = np.cumsum(part(n, 4, "<i4"))
    start = part(n, 8, "<i8")
    left, count, data = part(n, 1, None), part(n, 1, None), part(size, 1, None)
    return owners, names, Records(row, start, left, count, data)


def _deal(span: int, splits):
    def run(batches):
        for owners, names, records in _records(batches, span):
            bucket = np.searchsorted(splits.value, _keys(owners, records, span), side="right")
            order = np.argsort(bucket, kind="stable")
            sizes = np.bincount(bucket)
            ends = np.cumsum(sizes)
            found, packed = np.flatnonzero(sizes), []
            for code in found.tolist():
                own = order[ends[code] - sizes[code] : ends[code]]
                packed.append(_packed(owners, names, records.take(own, span)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(packed, pa.binary())], names=["bucket", "packed"]
            )

    return run


def _neighbours(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows, common prefixes along it, and per row the longer of the two."""
    order = multikey_order(characters(parts))
    common = common_prefixes(parts, order)
    most = np.zeros(len(order), dtype=np.int64)
    most[order] = np.maximum(common, np.append(common[1:], 0))
    return order, common, most


def repeated_windows(owner: np.ndarray, records: Records, span: int, low: bytes | None, high: bytes | None):
    """(record, offset, owner) of windows that a smaller owner has in this bucket too, and
    of windows first in this bucket that may also lie beyond the splitters ``low`` and
    ``high``. The offset is the distance from the window to its anchor."""
    right = right_parts(records, span)
    near = np.maximum(shared_with(right, low), shared_with(right, high))
    order, common, most = _neighbours(right)
    left = records.left.astype(np.int64)
    # A window reaches span - offset bytes right of its anchor; others cannot be equal.
    live = np.flatnonzero(np.maximum(most, near) + left >= span).astype(np.int32)
    records, owner, near = records.take(live, span), owner[live], near[live]
    right, left = right[live], left[live]
    order, common, most = _neighbours(right)
    before = left_parts(records, span)
    order_before, common_before, most_before = _neighbours(before)
    reach = np.maximum(most, near)
    most_before = np.where(near + left >= span, left, np.minimum(most_before, left))
    least = np.maximum(left - records.count.astype(np.int64) + 1, span - reach)
    repeated, first = [], []
    run, run_before = np.empty(len(live), np.int64), np.empty(len(live), np.int64)
    for offset in range(int(left.max(initial=-1)) + 1):
        own = np.flatnonzero((least <= offset) & (offset <= most_before))
        if not len(own):
            continue
        run[order] = np.cumsum(common < span - offset)
        run_before[order_before] = np.cumsum(common_before < offset)
        name = run[own] * (len(live) + 1) + run_before[own]
        by_name = np.argsort(name, kind="stable")
        own, name = own[by_name], name[by_name]
        heads = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        least_owner = np.minimum.reduceat(owner[own], heads)
        least_owner = np.repeat(least_owner, np.diff(np.append(heads, len(own))))
        later = owner[own] > least_owner
        repeated.append((live[own[later]], np.full(int(later.sum()), offset, np.uint8)))
        edge = own[~later & (near[own] >= span - offset)]
        first.append((live[edge], np.full(len(edge), offset, np.uint8)))
    both = []
    for pairs in (repeated, first):
        both.append([np.concatenate([p[i] for p in pairs] or [np.zeros(0, np.int32)]) for i in (0, 1)])
    return both


def _merged(row: np.ndarray, start: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the unions of windows [start, start + span)."""
    key = np.sort((row << 40) | start)
    row, start = key >> 40, key & ((1 << 40) - 1)
    if not len(key):
        return row, start, start
    head = np.append(True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + span))
    at = np.flatnonzero(head)
    return row[at], start[at], start[np.append(at[1:], len(key)) - 1] + span


def _lists(row: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    at = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    ends = np.append(at, len(row)).astype(np.int32)
    return row[at], pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))


def _distinct(owner: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, and the number of each entry's pair among them."""
    order = np.lexsort((name, owner))
    o, n = owner[order], name[order]
    head = np.append(True, (o[1:] != o[:-1]) | (n[1:] != n[:-1]))
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(head) - 1
    return o[head], n[head], number


def _solve(span: int, splits):
    width = -(-span // 8) * 8

    def run(key, table):
        bucket, keys = key[0].as_py(), splits.value
        edge = lambda i: keys[i : i + 1].tobytes()[:width] if 0 <= i < len(keys) else None
        owners, names, parts, texts = [], [], [], 0
        for packed in table["packed"]:
            owner, name, records = _unpacked(packed.as_py())
            records.row += texts
            texts += len(owner)
            owners.append(owner), names.append(name), parts.append(records)
        owner, name, text_of = _distinct(np.concatenate(owners), np.concatenate(names))
        records = joined(parts)
        records.row = text_of[records.row]
        del parts, table
        (found, offset), (open_at, open_offset) = repeated_windows(
            owner[records.row], records, span, edge(bucket - 1), edge(bucket)
        )
        left = records.left.astype(np.int64)
        row, start, end = _merged(records.row[found], (records.start + left)[found] - offset, span)
        rows, starts = _lists(row, start)
        _, ends = _lists(row, end)
        closed = pa.table(
            [
                pa.array(owner[rows]), pa.array(name[rows]), starts, ends,
                pa.nulls(len(rows), pa.binary()),
            ],
            names=["owner", "name", "starts", "ends", "window"],
        )
        sizes = records.count.astype(np.int64) + span - 1
        at = (np.cumsum(sizes) - sizes + left)[open_at] - open_offset
        windows = [records.data[i : i + span].tobytes() for i in at.tolist()]
        start = (records.start + left)[open_at] - open_offset
        single = pa.array(np.arange(len(at) + 1, dtype=np.int32))
        row = records.row[open_at]
        opened = pa.table(
            [
                pa.array(owner[row]), pa.array(name[row]),
                pa.ListArray.from_arrays(single, pa.array(start, pa.int64())),
                pa.ListArray.from_arrays(single, pa.array(start + span, pa.int64())),
                pa.array(windows, pa.binary()),
            ],
            names=closed.schema.names,
        )
        return pa.concat_tables([closed, opened])

    return run


def repeated_spans(rows: DataFrame, span: int = SPAN, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """owner, name, starts, ends: lists of byte spans of texts that repeat a text of
    smaller owner. ``rows`` has owner (bigint), name (bigint), text; owner and name
    together stand for a text. Lists of one text may come in several rows and overlap."""
    if not 16 <= span <= 255:
        raise ValueError("span must be between 16 and 255 bytes")
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(shuffle_partitions(spark), int(3.5 * total / bucket_bytes) + 1)
    splits = spark.sparkContext.broadcast(splitters(rows, span, buckets, total))
    dealt = rows.mapInArrow(_deal(span, splits), "bucket bigint, packed binary")
    found = stage(dealt.groupBy("bucket").applyInArrow(_solve(span, splits), _FOUND), "spans")
    # Each bucket names a window's first text only: rows per window are few.
    everywhere = Window.partitionBy("window")
    crossing = (
        found.where(F.col("window").isNotNull())
        .withColumn("least", F.min("owner").over(everywhere))
        .where(F.col("owner") > F.col("least"))
    )
    columns = ["owner", "name", "starts", "ends"]
    return found.where(F.col("window").isNull()).select(columns).unionByName(crossing.select(columns))


def _pack_texts(batches):
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column(3).cast(pa.large_binary())
        packed = [packer.compress(t.as_py() or b"") for t in texts]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(3)), pa.array(packed, pa.binary())],
            names=["doc_id", "owner", "name", "packed"],
        )


def _cut(batches):
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        sizes, kept, starts, ends = [], [], [], []
        for packed, groups in zip(batch.column(1), batch.column(2)):
            raw, own = unpack(packed.as_py()), groups.as_py()
            sizes.append(len(raw))
            a, b = _union(own)
            edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(raw)]
            kept.append(b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2])))
            starts.append(a)
            ends.append(b)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(starts, pa.list_(pa.int64())),
                pa.array(ends, pa.list_(pa.int64())), pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "starts", "ends", "kept"],
        )


def _union(groups: list | None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of the union of lists of spans."""
    if not groups:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.concatenate([np.array(g["starts"], np.int64) for g in groups])
    end = np.concatenate([np.array(g["ends"], np.int64) for g in groups])
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.append(True, start[1:] > end[:-1])
    return start[head], end[np.append(np.flatnonzero(head)[1:], len(start)) - 1]


def suffix_dedup(
    docs: DataFrame,
    span: int = SPAN,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, starts and ends of its maximal removed byte
    spans, and the bytes that are kept.

    A byte goes if it lies in a string of ``span`` bytes that also starts in a document of
    smaller id. Null text counts as empty. A missing id counts as smaller than any other.
    Rows of one id never remove from each other, so repeated rows get equal results and
    texts of one id are judged apart. Texts shorter than ``span`` stay whole. Ids are
    integers; other columns are not read. A long text is handled in parts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NOBODY)).alias("owner"),
        F.xxhash64(body).alias("name"),
        body.alias("text"),
    )
    spans = repeated_spans(rows.select("owner", "name", "text"), span, bucket_bytes)
    of_text = spans.groupBy("owner", "name").agg(F.collect_list(F.struct("starts", "ends")).alias("groups"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    texts = rows.mapInArrow(_pack_texts, f"doc_id {kind}, owner bigint, name bigint, packed binary")
    both = texts.join(of_text, ["owner", "name"], "left").select("doc_id", "packed", "groups")
    return both.mapInArrow(
        _cut, f"doc_id {kind}, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"
    )


def suffix_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of ``suffix_dedup``."""
    found = suffix_dedup(docs, **options)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("starts").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
