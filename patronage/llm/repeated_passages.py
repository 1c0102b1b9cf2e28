"""Repeated passages: paragraphs by MinHash banding and exact verification, and runs of
equal sentences for passages that lie inside otherwise different paragraphs.

A paragraph is a line of at least ``min_words`` words. Its five-word shingles give
``BANDS`` buckets; paragraphs that meet in a bucket are compared with two centres of the
bucket, then with all others of it that are still in another class (``buckets``). Pairs
that reach the similarity become links, and components of links are classes. Equal
paragraphs are one vertex from the start. Sentences of five words or more
are vertices too, joined only with equal ones: a passage put into a longer paragraph is
found by the run of its sentences, if their words are ``min_words`` or more in all.

A class counts as repeated when it occurs in at least two documents. The occurrence in
the document of least id stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.buckets import large_links, opened, small_pairs
from patronage.llm.components import components
from patronage.llm.near_dedup import _row_key, _stream, similarities
from patronage.llm.shingles import SHINGLE, counted, shingle_hashes
from patronage.llm.text import Block, Words, blocks, mix, row_sums
from patronage.session import stage

MIN_WORDS = 25
GAP_WORDS = 10  # words of short sentences that may lie between two of a run
SIMILARITY = 0.8
BANDS = 10
ROWS = 3  # a pair at 0.8 is missed by all bands once in 1,300 times


class Units:
    """Lines and sentences of a block as slices of its words."""

    def __init__(self, block: Block):
        self.words = Words(block)
        data, n = block.data, len(block.data)
        feed = data == 10
        stop = (data == 46) | (data == 33) | (data == 63)
        ended = stop.copy()
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        if n:
            ended[:-1] &= blank[1:]
        self.gaps = np.union1d(np.flatnonzero(blank), block.offsets)
        line_ends = np.concatenate([np.flatnonzero(feed) + 1, block.offsets])
        sentence_ends = np.concatenate([np.flatnonzero(ended | feed) + 1, block.offsets])
        self.lines = self._slices(line_ends)
        self.sentences = self._slices(sentence_ends)

    def _slices(self, ends: np.ndarray) -> np.ndarray:
        """Bounds in words, without empty slices."""
        return np.unique(np.searchsorted(self.words.starts, ends))

    def ends(self, last: np.ndarray) -> np.ndarray:
        """Where slices end that end with these words: signs after a word belong to it."""
        return self.gaps[np.searchsorted(self.gaps, self.words.starts[last] + self.words.lengths[last])]

    def names(self, bounds: np.ndarray) -> np.ndarray:
        """A hash of the word sequence of every slice."""
        counts = np.diff(bounds)
        place = np.arange(len(self.words.hashes)) - np.repeat(bounds[:-1], counts)
        mixed = mix(self.words.hashes + mix(place.astype(np.uint64)))
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
        return mix(total[bounds[1:]] - total[bounds[:-1]] + counts.astype(np.uint64))


def line_buckets(units: Units, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash bands of slices that all have words."""
    shingles, ends = shingle_hashes(units.words.hashes, bounds)
    out = np.zeros((len(bounds) - 1, bands), dtype=np.uint64)
    if not len(out):
        return out
    for band in range(bands):
        bucket = np.full(len(out), band + 1, dtype=np.uint64)
        for row in range(rows):
            least = np.minimum.reduceat(mix(shingles ^ _stream(band * rows + row + 1)), ends[:-1])
            bucket = mix(bucket * _stream(1) + least)
        out[:, band] = bucket
    return out


def _units(is_line: bool, min_words: int, bands: int, rows: int):
    """Rows of UNIT_SCHEMA for the lines or the sentences of ``min_words`` words or more;
    sentences have no buckets."""
    names = ["doc", "line", "start", "bytes", "first_word", "n_words", "h"]

    def run(batches):
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            for row, block in blocks(batch.column(1)):
                units = Units(block)
                words = units.words
                if not len(words.starts):
                    continue
                bounds = units.lines if is_line else units.sentences
                counts = np.diff(bounds)
                keep = np.flatnonzero(counts >= min_words)
                h = units.names(bounds)
                # A sentence and a line of the same words are different vertices.
                h = mix(h + np.uint64(1)) if is_line else h
                first, last = bounds[:-1][keep], bounds[1:][keep] - 1
                own = block.rows_of(words.starts[first])
                start = words.starts[first] - block.offsets[own]
                end = units.ends(last) - block.offsets[own]
                columns = [
                    pa.array(docs[row + own]),
                    pa.array(np.full(len(keep), is_line)),
                    pa.array(start),
                    pa.array(end - start),
                    pa.array(first - words.bounds[own]),
                    pa.array(counts[keep]),
                    pa.array(h[keep].view(np.int64)),
                ]
                if is_line:
                    buckets = line_buckets(units, bounds, bands, rows)[keep].view(np.int64)
                    ends = np.arange(len(keep) + 1, dtype=np.int32) * bands
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(buckets.ravel())))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "buckets"][: len(columns)])

    return run


UNIT_SCHEMA = (
    "doc bigint, line boolean, start bigint, bytes bigint, first_word bigint, n_words bigint, h bigint"
)


def _centred(members: DataFrame) -> DataFrame:
    """``members`` of the buckets of several, with the two centres of their bucket: the
    least and the greatest member by an order of each bucket's own."""
    order = F.col("h").bitwiseXOR(F.xxhash64("bucket"))
    centres = (
        members.groupBy("bucket")
        .agg(F.min(order).alias("low"), F.max(order).alias("high"))
        .where("low < high")
    )
    shift = F.xxhash64("bucket")
    return members.join(centres, "bucket").select(
        "bucket", "h", F.col("low").bitwiseXOR(shift).alias("low"), F.col("high").bitwiseXOR(shift).alias("high")
    )


def _pairs(centred: DataFrame) -> DataFrame:
    """(member, centre) pairs, each once."""
    pairs = centred.select("h", F.explode(F.array("low", "high")).alias("c")).where("h != c")
    return pairs.select(F.least("h", "c").alias("a"), F.greatest("h", "c").alias("b")).distinct()


def _cut_out(batches):
    """The text of one unit from the text of its document."""
    for batch in batches:
        starts, sizes = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        out = []
        for row, block in blocks(batch.column(1)):
            for i in range(len(block)):
                at = int(block.offsets[i]) + starts[row + i]
                out.append(block.text(at, at + sizes[row + i]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["h", "text"])


def _verified(similarity: float):
    def bags(column):
        for _, block in blocks(column):
            words = Words(block)
            own, counts, bounds = counted(*shingle_hashes(words.hashes, words.bounds))
            yield from ((own[a:b], counts[a:b]) for a, b in zip(bounds[:-1], bounds[1:]))

    def run(batches):
        for batch in batches:
            near = [
                similarities(a, b)[1] >= similarity
                for a, b in zip(bags(batch.column(2)), bags(batch.column(3)))
            ]
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"]
            )

    return run


def repeated_passages(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per occurrence of a repeated paragraph or sentence: doc_id, class_id,
    keep_id (document whose occurrence stays), line (a paragraph, else a sentence), start
    and bytes (UTF-8 place in the text), n_words, kept, and ``doc``, which names the row
    of ``docs``.

    A document without repeated passages has no row. Rows of equal id and text are one
    document; repeats inside one document do not count. Null and empty texts have no
    passage. Texts are used whole; other columns are not read.
    """
    identity, tie = _row_key(doc_id, text)
    source = docs.select(
        F.xxhash64(identity, tie).alias("doc"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    texts_only = source.select("doc", "text")
    lines = stage(
        texts_only.mapInArrow(_units(True, min_words, bands, rows), f"{UNIT_SCHEMA}, buckets array<bigint>"), "lines"
    )
    # Most sentences occur once: they are made twice rather than written.
    sentences = texts_only.mapInArrow(_units(False, SHINGLE, bands, rows), UNIT_SCHEMA)
    # Equal paragraphs have equal buckets: one row per vertex before they are dealt out.
    members = lines.groupBy("h").agg(F.first("buckets").alias("buckets"))
    centred = stage(_centred(members.select(F.explode("buckets").alias("bucket"), "h")), "members")
    pairs = stage(_pairs(centred), "pairs")
    holders = lines.join(
        pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "h", "left_semi"
    )
    place = F.min(F.struct("doc", "start", "bytes")).alias("p")
    holders = holders.groupBy("h").agg(place).select("h", "p.doc", "p.start", "p.bytes")
    texts = stage(
        source.join(holders, "doc")
        .groupBy("h")
        .agg(F.first(F.struct("text", "start", "bytes")).alias("u"))
        .select("h", "u.text", "u.start", "u.bytes")
        .mapInArrow(_cut_out, "h bigint, text string"),
        "passages",
    )
    left = texts.select(F.col("h").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("h").alias("b"), F.col("text").alias("right"))

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return both.mapInArrow(_verified(similarity), "a bigint, b bigint")

    links = stage(verified(pairs), "links")
    labels = components(links)
    members = centred.join(labels.withColumnRenamed("node", "h"), "h", "left").select(
        "bucket", F.col("h").alias("h1"), F.lit(0).alias("h2"), F.coalesce("label", "h").alias("label")
    )
    # Every bucket that still holds several classes is compared in full.
    still = opened(members)
    rest = small_pairs(still).select(F.least("a1", "b1").alias("a"), F.greatest("a1", "b1").alias("b")).distinct()
    keyed = texts.select(F.col("h").alias("h1"), F.lit(0).alias("h2"), "text")
    more = verified(rest.join(pairs, ["a", "b"], "left_anti")).unionByName(
        large_links(still, keyed, similarity, None)
    )
    labels = components(links.unionByName(more))
    spread = (
        lines.groupBy("h")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .join(labels.withColumnRenamed("node", "h"), "h", "left")
        .withColumn("class_id", F.coalesce("label", "h"))
    )
    repeated = (
        spread.groupBy("class_id")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high")
        .select("class_id")
    )
    vertices = spread.select("h", "class_id").join(repeated, "class_id", "left_semi")
    paragraphs = lines.drop("buckets").join(vertices, "h").drop("h")
    again = sentences.groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    equal = sentences.join(again.select("h", F.col("h").alias("class_id")), "h").drop("h")
    return _occurrences(paragraphs.unionByName(_in_runs(equal, min_words)), source)


def _in_runs(found: DataFrame, min_words: int) -> DataFrame:
    """Sentences of runs that are long enough in all. A run goes on from one sentence to
    the next if another document has the two in the same order and as near."""
    along = Window.partitionBy("doc").orderBy("first_word")
    end = F.col("first_word") + F.col("n_words")
    # One document's passages share a task: its text is one value of the input already.
    gap = F.lead("first_word").over(along) - end
    following = found.dropDuplicates(["doc", "first_word"]).withColumn(
        "next_id", F.when(gap <= GAP_WORDS, F.lead("class_id").over(along))
    )
    following = stage(following, "sentences")
    pairs = (
        following.where("next_id IS NOT NULL")
        .groupBy("class_id", "next_id")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .where("low < high")
        .select("class_id", "next_id", F.lit(True).alias("goes_on"))
    )
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.coalesce(~F.lag(F.coalesce("goes_on", F.lit(False))).over(along), F.lit(True))
    runs = (
        following.join(pairs, ["class_id", "next_id"], "left")
        .withColumn("opens", opens.cast("int"))
        .withColumn("run", F.sum("opens").over(upto))
        .withColumn("run_words", F.sum("n_words").over(Window.partitionBy("doc", "run")))
    )
    return runs.where(F.col("run_words") >= min_words).drop("next_id", "goes_on", "opens", "run", "run_words")


def _occurrences(found: DataFrame, source: DataFrame) -> DataFrame:
    """Ids of documents, and which occurrence of each class stays."""
    found = stage(found, "occurrences")
    ids = source.select("doc", "doc_id").distinct()
    named = found.join(ids, "doc")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc")
    best = named.groupBy("class_id").agg(
        F.min(order).alias("best"), F.min("doc").alias("low"), F.max("doc").alias("high")
    )
    # A class may have lost its other documents to the length of runs.
    return named.join(best.where("low < high"), "class_id").select(
        "doc_id",
        "class_id",
        F.col("best.doc_id").alias("keep_id"),
        "line",
        "start",
        "bytes",
        "n_words",
        (F.col("doc") == F.col("best.doc")).alias("kept"),
        "doc",
    )


def _without(batches):
    for batch in batches:
        spans = batch.column(batch.schema.get_field_index("spans"))
        out = []
        for row, block in blocks(batch.column(batch.schema.get_field_index("text"))):
            for i in range(len(block)):
                at, end, kept = int(block.offsets[i]), int(block.offsets[i + 1]), []
                base = at
                for span in sorted((s["start"], s["start"] + s["bytes"]) for s in spans[row + i].as_py() or ()):
                    if base + span[0] > at:
                        kept.append(block.data[at : base + span[0]].tobytes())
                    at = max(at, base + span[1])
                kept.append(block.data[at:end].tobytes())
                out.append(b"".join(kept).decode("utf-8", "replace"))
        at = batch.schema.get_field_index("text")
        columns = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with every occurrence of a repeated passage cut out but the one that
    stays. Documents stay even if nothing is left; null text stays null."""
    gone = repeated_passages(docs, doc_id=doc_id, text=text, **options).where("NOT kept")
    spans = gone.groupBy("doc").agg(F.collect_list(F.struct("start", "bytes")).alias("spans"))
    others = [c for c in docs.columns if c != text]
    rows = docs.select(
        F.xxhash64(*_row_key(doc_id, text)).alias("doc"),
        F.struct(*[F.col(c) for c in others], F.lit(0).alias("_")).alias("row"),
        F.col(text).alias("text"),
    ).join(spans, "doc", "left")
    hit = rows.where("spans IS NOT NULL")
    cut = hit.mapInArrow(_without, hit.schema).unionByName(rows.where("spans IS NULL"))
    return cut.select(
        *[(F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns]
    )
