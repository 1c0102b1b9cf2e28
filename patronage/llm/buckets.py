"""Exact comparison inside the buckets of a banding search.

Centres join most of a bucket at little cost, but two members may be near each other and
far from every centre. What is left after them, buckets that hold several classes, is
compared here in full: every pair of different classes is verified or already joined.

Pairs of a small bucket are rows. A large bucket is cut into chunks of about ``CHUNK``
members by hash, and a pair of chunks is one task's group: a class that fills chunks of
its own is never compared with itself, so the work is the members outside large classes
times all members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.shingles import block_shingles
from patronage.llm.text import Words, blocks
from patronage.session import stage

SMALL = 8
CHUNK = 200
_COLUMNS = 4096


def opened(members: DataFrame) -> DataFrame:
    """``members`` (bucket, h1, h2, label) of the buckets with several labels, and the
    size ``n`` of their bucket."""
    sizes = (
        members.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select("bucket", "n")
    )
    return stage(members.join(sizes, "bucket"), "open")


def small_pairs(members: DataFrame) -> DataFrame:
    """(a1, a2, b1, b2, a_label, b_label): all pairs of different labels, each once, from
    the small buckets of what ``opened`` returns."""
    own = members.where(F.col("n") <= SMALL).drop("n")
    left = own.select("bucket", *[F.col(c).alias(n) for c, n in zip(("h1", "h2", "label"), ("a1", "a2", "a_label"))])
    right = own.select("bucket", *[F.col(c).alias(n) for c, n in zip(("h1", "h2", "label"), ("b1", "b2", "b_label"))])
    pairs = left.join(right, (left["bucket"] == right["bucket"]) & (F.col("a_label") < F.col("b_label")))
    return pairs.select("a1", "a2", "b1", "b2", "a_label", "b_label").distinct()


def large_links(members: DataFrame, texts: DataFrame, similarity: float, weighted) -> DataFrame:
    """(a, b): labels joined by the pairs of the large buckets of what ``opened`` returns.

    ``texts`` has h1, h2, text. ``weighted`` gives the similarity of two (shingles,
    counts) pairs that also counts as near, if there is one beside plain Jaccard.
    """
    members = members.where(F.col("n") > SMALL).drop("n")
    counted = members.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    alone = counted.where(F.col("n") >= CHUNK).select(
        "bucket", "label", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts")
    )
    mixed = (
        counted.where(F.col("n") < CHUNK)
        .groupBy("bucket")
        .agg(F.ceil(F.sum("n") / CHUNK).cast("int").alias("rest"))
    )
    spot = lambda parts: F.pmod(F.xxhash64("h1", "h2"), F.col(parts)).cast("int")
    own = F.when(F.col("parts").isNull(), F.struct(F.lit(False).alias("alone"), F.lit(0).cast("bigint").alias("own"), spot("rest").alias("k")))
    own = own.otherwise(F.struct(F.lit(True).alias("alone"), F.col("label").alias("own"), spot("parts").alias("k")))
    placed = stage(
        members.join(alone, ["bucket", "label"], "left")
        .join(mixed, "bucket", "left")
        .select("bucket", "h1", "h2", "label", own.alias("chunk")),
        "chunks",
    )
    chunks = placed.select("bucket", "chunk").distinct()
    couples = chunks.withColumnRenamed("chunk", "c").join(chunks.withColumnRenamed("chunk", "d"), "bucket")
    same = F.col("c.alone") & F.col("d.alone") & (F.col("c.own") == F.col("d.own"))
    couples = couples.where((F.col("c") <= F.col("d")) & ~same).select(
        "bucket",
        F.xxhash64("bucket", "c", "d").alias("block"),
        F.explode(
            F.when(F.col("c") == F.col("d"), F.array(F.struct(F.col("c").alias("chunk"), F.lit(0).alias("side"))))
            .otherwise(F.array(*[F.struct(F.col(x).alias("chunk"), F.lit(k).alias("side")) for k, x in ((1, "c"), (2, "d"))]))
        ).alias("s"),
    )
    dealt = placed.join(couples.select("bucket", "block", "s.chunk", "s.side"), ["bucket", "chunk"])
    return (
        dealt.select("block", "side", "h1", "h2", "label")
        .join(texts, ["h1", "h2"])
        .select("block", "side", "label", "text")
        .groupBy("block")
        .applyInArrow(_compared(similarity, weighted), "a bigint, b bigint")
    )


def _compared(similarity: float, weighted):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own, counts, sizes = [], [], []
        for chunk in table["text"].chunks:
            for _, block in blocks(chunk):
                s, n, bounds = block_shingles(Words(block))
                own.append(s)
                counts.append(n)
                sizes.append(np.diff(bounds))
        bags = tuple(np.concatenate(x) for x in (own, counts, sizes))
        links = near_labels(*bags, table["label"].to_numpy(), table["side"].to_numpy(), similarity, weighted)
        found = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    return run


def near_labels(own, counts, sizes, label, side, similarity: float, weighted=None) -> list[tuple[int, int]]:
    """Links that join all labels with near members on the two sides: 1 against 2, or 0
    against itself. Shingles that only one member has are in no intersection."""
    members = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    total = np.concatenate([[0], np.cumsum(counts)])
    total = total[ends[1:]] - total[ends[:-1]]
    left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    _, column, held = np.unique(own, return_inverse=True, return_counts=True)
    use = np.flatnonzero(held[column] > 1)
    use = use[np.argsort(column[use], kind="stable")]
    rows = members[use]
    column = np.cumsum(np.diff(column[use], prepend=column[use[:1]]) > 0) if len(use) else use
    often = total > sizes
    weighted = weighted if often.any() else None
    mass = counts[use] / np.maximum(total[rows], 1)
    shared, p, q = (np.zeros((len(left), len(right))) for _ in range(3))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [at, at + _COLUMNS])
        x = np.zeros((len(sizes), int(column[b - 1]) - at + 1), dtype=np.float32)
        x[rows[a:b], column[a:b] - at] = 1
        shared += x[left] @ x[right].T
        if weighted:
            y = np.zeros_like(x)
            y[rows[a:b], column[a:b] - at] = mass[a:b]
            p += y[left] @ x[right].T
            q += x[left] @ y[right].T
    apart = label[left][:, None] != label[right][None, :]
    either = sizes[left][:, None] + sizes[right][None, :] - shared
    near = apart & (shared > 0) & (shared / np.maximum(either, 1) >= similarity)
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    links = []

    def join(i: int, j: int) -> None:
        a, b = find(int(label[i])), find(int(label[j]))
        if a != b:
            top[b] = a
            links.append((int(label[i]), int(label[j])))

    for i, j in zip(*np.nonzero(near)):
        join(left[i], right[j])
    if weighted:
        # Probability Jaccard is at most the mass of either on the other's shingles, and
        # it is plain Jaccard where nothing is repeated.
        maybe = apart & ~near & (np.minimum(p, q) >= similarity - 1e-4) & (often[left][:, None] | often[right][None, :])
        bag = lambda i: (own[ends[i] : ends[i + 1]], counts[ends[i] : ends[i + 1]])
        for i, j in zip(*np.nonzero(maybe)):
            i, j = left[i], right[j]
            if find(int(label[i])) != find(int(label[j])) and weighted(bag(i), bag(j)) >= similarity:
                join(i, j)
    return links
