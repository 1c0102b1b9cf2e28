"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is the multiset of its five-word shingles. Every shingle emits arrivals of a
Poisson process whose rate is its count; an arrival claims a random slot if it comes
before what the slot holds, and a shingle stops once its next arrival is later than the
latest slot. Two documents agree in a slot with their probability Jaccard similarity.
Documents that repeat shingles also get the bands of their shingles counted once, where
the agreement is plain Jaccard; for others both are the same.

Documents of equal shingle counts are one vertex from the start, so copies never meet
in a bucket. Within a bucket each vertex is compared with a few centres in rounds; what
is then still apart in a bucket is compared in full (``buckets``), so that every pair that
meets in a bucket is verified or already joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.buckets import large_links, opened, small_pairs
from patronage.llm.components import components
from patronage.llm.shingles import SHINGLE, block_shingles
from patronage.llm.text import Words, blocks, mix, ragged
from patronage.session import stage

BANDS = 24
ROWS = 4  # slots per band: a pair at 0.8 is missed by all bands once in 300,000 times
# Buckets (one in so many) and centres per bucket of each round. They join most copies at
# little cost, so that the full comparison after them only has what is still apart.
ROUNDS = ((8, 1), (1, 2))
SIMILARITY = 0.8
_GOLDEN = 0x9E3779B97F4A7C15


def _stream(k: int) -> np.uint64:
    """The k-th constant that makes one hash into many."""
    return np.uint64(_GOLDEN * k & 0xFFFFFFFFFFFFFFFF)


def prob_min_hash(
    shingles: np.ndarray, weights: np.ndarray, bounds: np.ndarray, slots: int
) -> np.ndarray:
    """Slots of every document: the shingle that owns each. Documents without shingles
    have zeros."""
    documents = len(bounds) - 1
    rows = np.repeat(np.arange(documents), np.diff(bounds))
    earliest = np.full(documents * slots, np.inf)
    owner = np.zeros(documents * slots, dtype=np.uint64)
    time = np.zeros(len(shingles))
    active = np.arange(len(shingles))
    step = 0
    while len(active):
        step += 1
        random = mix(shingles[active] + _stream(2 * step))
        uniform = ((random >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53
        time[active] -= np.log(uniform) / weights[active]
        place = mix(shingles[active] + _stream(2 * step + 1)) % np.uint64(slots)
        at = rows[active] * slots + place.astype(np.int64)
        now = time[active]
        sooner = np.flatnonzero(now < earliest[at])
        sooner = sooner[np.argsort(-now[sooner], kind="stable")]  # the earliest is written last
        earliest[at[sooner]] = now[sooner]
        owner[at[sooner]] = shingles[active[sooner]]
        latest = earliest.reshape(documents, slots).max(axis=1)
        active = active[now < latest[rows[active]]]
    return owner.reshape(documents, slots)


def similarities(a, b) -> tuple[float, float]:
    """Probability Jaccard and plain Jaccard of two (shingles, counts) pairs."""
    (left, m), (right, n) = a, b
    if not len(left) or not len(right):
        return 0.0, 0.0
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    plain = len(i) / (len(left) + len(right) - len(i))
    p, q = m / m.sum(), n / n.sum()
    ratio, which = np.unique(np.round(q[j] / p[i], 12), return_inverse=True)
    alone = np.delete(q, j).sum()
    total = 0.0
    for k, r in enumerate(ratio):
        whole = np.maximum(p[i], q[j] / r).sum() + np.delete(p, i).sum() + alone / r
        total += p[i][which == k].sum() / whole
    return float(total), plain


def _buckets(owner: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band of every document's slots."""
    owner = owner.reshape(len(owner), bands, rows)
    bucket = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), owner.shape[:2])
    for k in range(rows):
        bucket = mix(bucket * _stream(1) + owner[:, :, k])
    return bucket


def _signatures(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            names, bucket_rows, bucket_ends = [[], []], [], []
            for _, block in blocks(batch.column(2)):
                own, counts, bounds = block_shingles(Words(block))
                # Order does not matter to the sums, so they name the multiset.
                weight = counts.astype(np.uint64)
                for k, name in enumerate(names):
                    mixed = mix(own + _stream(k + 3)) * mix(weight + np.uint64(17 * k))
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(mixed), dtype=np.uint64)])
                    name.append(total[bounds[1:]] - total[bounds[:-1]])
                full = np.diff(bounds) > 0
                often = np.add.reduceat(counts > 1, bounds[:-1][full]) > 0 if full.any() else full[:0]
                owner = prob_min_hash(own, counts.astype(np.float64), bounds, bands * rows)
                weighted = _buckets(owner, bands, rows)[full]
                # Only documents with repeats are signed again, with every count at one.
                twice = np.flatnonzero(full)[often]
                sizes = np.diff(bounds)[twice]
                again = np.concatenate([[0], np.cumsum(sizes)])
                part = own[ragged(bounds[:-1][twice], sizes)] if len(twice) else own[:0]
                plain = _buckets(prob_min_hash(part, np.ones(len(part)), again, bands * rows), bands, rows)
                # Rows of a document: its weighted bands, then those of its plain ones
                # that differ, so no document is in a bucket twice.
                held = np.ones((len(weighted), 2, bands), dtype=bool)
                held[:, 1] = False
                both = np.stack([weighted, weighted], axis=1)
                both[often, 1] = plain
                held[often, 1] = plain != weighted[often]
                bucket_rows.append(both[held])
                size = np.zeros(len(block), dtype=np.int64)
                size[full] = held.sum(axis=(1, 2))
                bucket_ends.append(size)
            flat = np.concatenate(bucket_rows or [np.zeros(0, np.uint64)]).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.concatenate(bucket_ends or [[]]))])
            code = [np.concatenate(n or [np.zeros(0, np.uint64)]).view(np.int64) for n in names]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(code[0]),
                    pa.array(code[1]),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)),
                ],
                names=["id", "tie", "h1", "h2", "buckets"],
            )

    return run


def _verified(similarity: float):
    def shingled(column):
        for _, block in blocks(column):
            own, counts, bounds = block_shingles(Words(block))
            order = [own[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            yield from zip(order, (counts[a:b] for a, b in zip(bounds[:-1], bounds[1:])))

    def run(batches):
        for batch in batches:
            near = [
                max(similarities(a, b)) >= similarity
                for a, b in zip(shingled(batch.column(2)), shingled(batch.column(3)))
            ]
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"]
            )

    return run


def _row_key(doc_id: str, text: str):
    """What tells rows apart: the id as text (null: empty) and a hash of the text."""
    return (
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.xxhash64(text).alias("tie"),
    )


def _pairs(members: DataFrame, centres: int, salt: int) -> DataFrame:
    """(a1, a2, b1, b2): every member of a bucket with some centres of the bucket, if
    their labels differ; each pair once. ``members`` has bucket, h1, h2, label.

    Centres are the least members by orders that change with the bucket and the salt. The
    partial aggregate leaves one row per bucket and task, whatever the bucket's size.
    """
    chosen, names = [F.min("label").alias("low"), F.max("label").alias("high")], []
    for k in range(centres):
        order = F.col("h1").bitwiseXOR(F.xxhash64("bucket", F.lit(salt), F.lit(k)))
        names.append([f"{c}_{k}" for c in ("h1", "h2", "label")])
        chosen += [F.min_by(c, order).alias(n) for c, n in zip(("h1", "h2", "label"), names[-1])]
    open_buckets = members.groupBy("bucket").agg(*chosen).where("low < high").drop("low", "high")
    centre = F.explode(
        F.array(*[F.struct(*[F.col(n).alias(c) for n, c in zip(own, ("g1", "g2", "other"))]) for own in names])
    )
    pairs = (
        members.join(open_buckets, "bucket")
        .withColumn("c", centre)
        .select("h1", "h2", "label", "c.*")
        .where("label != other")
    )
    turned = (F.col("h1") > F.col("g1")) | ((F.col("h1") == F.col("g1")) & (F.col("h2") > F.col("g2")))
    return pairs.select(
        F.when(turned, F.col("g1")).otherwise(F.col("h1")).alias("a1"),
        F.when(turned, F.col("g2")).otherwise(F.col("h2")).alias("a2"),
        F.when(turned, F.col("h1")).otherwise(F.col("g1")).alias("b1"),
        F.when(turned, F.col("h2")).otherwise(F.col("g2")).alias("b2"),
        F.least("label", "other").alias("a_label"),
        F.greatest("label", "other").alias("b_label"),
    ).distinct()


def near_groups(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, and ``id``, ``tie`` that
    tell its row.

    Two documents are linked if the probability Jaccard or the plain Jaccard similarity
    of their shingles is at least ``similarity``; classes are the components of links.
    ``class_id`` is the least doc_id of a class (null only if all are), and one row of it
    is kept. A text of one to four words is one shingle. Texts without words (null, empty)
    are linked to nothing. Rows of equal id and text are one class; other columns are
    not read.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *_row_key(doc_id, text))
    signed = stage(
        source.select("id", "tie", "text").mapInArrow(
            _signatures(bands, rows), "id string, tie bigint, h1 bigint, h2 bigint, buckets array<bigint>"
        ),
        "signatures",
    )
    signed_ids = signed.select("id", "tie", "h1", "h2", (F.size("buckets") > 0).alias("worded"))
    # Copies have equal buckets: one row per vertex before they are dealt out.
    members = (
        signed.groupBy("h1", "h2")
        .agg(F.first("buckets").alias("buckets"))
        .select(F.explode("buckets").alias("bucket"), "h1", "h2")
    )
    several = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    # Only buckets of several vertices go on; at first every vertex is its own class.
    members = stage(
        members.join(several, "bucket", "left_semi").withColumn("label", F.col("h1")), "members"
    )
    holders = (
        signed_ids.join(members.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2")
        .agg(F.min(F.struct("id", "tie")).alias("row"))
        .select("h1", "h2", "row.*")
    )
    texts = stage(
        source.select("id", "tie", "text")
        .join(holders, ["id", "tie"])
        .groupBy("h1", "h2")
        .agg(F.first("text").alias("text")),
        "texts",
    )

    def verified(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("text").alias("left"))
        right = texts.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("text").alias("right"))
        joined = pairs.join(left, ["a1", "a2"]).join(right, ["b1", "b2"])
        return joined.select("a_label", "b_label", "left", "right").mapInArrow(
            _verified(similarity), "a bigint, b bigint"
        )

    # Each round compares members with centres of other classes, and joins the classes
    # that proved near.
    def joined(members: DataFrame, links: DataFrame) -> DataFrame:
        merged = components(links).select(F.col("node").alias("label"), F.col("label").alias("top"))
        return stage(
            members.join(merged, "label", "left").select(
                "bucket", "h1", "h2", F.coalesce("top", "label").alias("label")
            ),
            "members",
        )

    for salt, (part, centres) in enumerate(ROUNDS):
        own = members.where(F.pmod("bucket", F.lit(part)) == 0) if part > 1 else members
        members = joined(members, stage(verified(_pairs(own, centres, salt)), "near"))
    still = opened(members)
    found = verified(small_pairs(still)).unionByName(
        large_links(still, texts, similarity, lambda a, b: similarities(a, b)[0])
    )
    members = joined(members, stage(found, "near"))
    # A vertex that was never linked has its own first half as label; the second half
    # tells it from any other.
    found = members.select("h1", "h2", "label").distinct()
    linked = found.groupBy("label").agg(F.count("*").alias("n")).where("n > 1").select("label")
    found = found.join(linked, "label")
    vertices = (
        signed_ids.groupBy("h1", "h2")
        .agg(F.max("worded").alias("worded"))
        .join(found, ["h1", "h2"], "left")
        .select("h1", "h2", "worded", F.coalesce(F.col("label").cast("string"), F.concat_ws(",", "h1", "h2")).alias("label"))
    )
    return _classes(source, signed_ids, vertices)


def _classes(source: DataFrame, signed_ids: DataFrame, vertices: DataFrame) -> DataFrame:
    """Documents with their class: least id, size, and the one row that is kept."""
    own = source.select("doc_id", "id", "tie")
    rows = own.groupBy("doc_id", "id", "tie").agg(F.count("*").alias("copies"))
    labelled = signed_ids.distinct().drop("worded").join(vertices, ["h1", "h2"])
    # A text without words is a class of its own row.
    label = F.when(F.col("worded"), F.col("label")).otherwise(F.concat_ws(" ", "id", F.col("tie").cast("string")))
    members = rows.join(labelled.select("id", "tie", label.alias("label")), ["id", "tie"])
    members = stage(members, "members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("tie").alias("tie"))
    classes = members.groupBy("label").agg(
        F.min(order).alias("best"), F.sum("copies").alias("size")
    )
    placed = members.join(classes, "label").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))
    )
    return placed.select(
        "doc_id",
        F.col("best.doc_id").alias("class_id"),
        F.col("size").alias("class_size"),
        ((order == F.col("best")) & (F.col("copy") == 1)).alias("kept"),
        "id",
        "tie",
    )


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class; all columns stay as they are."""
    kept = near_groups(docs, doc_id=doc_id, text=text, **options).where("kept").select("id", "tie")
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *_row_key(doc_id, text))
    once = whole.groupBy("id", "tie").agg(F.first("row").alias("row"))
    return once.join(kept, ["id", "tie"], "left_semi").select("row.*")
