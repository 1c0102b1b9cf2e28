"""Ranked lexical search by the no-random-access algorithm.

The documents are divided into shards of bounded size, each with its own inverted lists
sorted by impact; statistics (documents, words, document frequencies) are those of the
whole table. In a shard the lists of an item are read in order, in growing steps, and
nothing is looked up out of order. Of every document the reader keeps a lower bound (the
impacts seen) and an upper bound (plus, for each list it was not seen in, the impact where
that list stands). It stops when every document whose upper bound reaches the k-th lower
bound has equal bounds: then membership, ties and scores are exact. The best of all
shards are merged per item.

Items are taken in blocks of bounded size; each block costs two passes over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.text import Words, blocks
from patronage.session import stage

BLOCK_TERMS = 200_000  # words of items, repeats included, that are searched together
SHARD_POSTINGS = 2_000_000
FIRST_STEP = 64


@dataclass
class Terms:
    """The distinct terms of some items: sorted hashes and the terms themselves."""

    hashes: np.ndarray
    names: list[bytes]


def item_blocks(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator[tuple[list, Terms, list]]:
    """(ids, terms, term numbers per item) for blocks of distinct items."""
    rows = items.select(F.col(item_id).alias("id"), F.col(text).alias("text")).distinct()
    ids, own, names, size = [], [], {}, 0
    for row in rows.toLocalIterator():
        found = []
        for _, block in blocks(pa.array([row["text"]], pa.string())):
            words = Words(block)
            _, first = np.unique(words.hashes, return_index=True)
            for i in first.tolist():
                start = words.starts[i]
                term = words.data[start : start + words.lengths[i]].tobytes()
                found.append(names.setdefault(term, (len(names), words.hashes[i]))[0])
        if not found:
            continue
        ids.append(row["id"])
        own.append(found)
        size += len(found)
        if size >= limit:
            yield ids, *_numbered(names, own)
            ids, own, names, size = [], [], {}, 0
    if ids:
        yield ids, *_numbered(names, own)


def _numbered(names: dict, own: list[list[int]]) -> tuple[Terms, list[np.ndarray]]:
    terms, hashes = list(names), np.array([h for _, h in names.values()], dtype=np.uint64)
    order = np.argsort(hashes, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return Terms(hashes[order], [terms[i] for i in order]), [np.sort(number[o]) for o in own]


def _occurrences(words: Words, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """(place among the words, term) of every word that is a term; bytes are compared."""
    at = np.minimum(np.searchsorted(terms.hashes, words.hashes), len(terms.hashes) - 1)
    places = np.flatnonzero(terms.hashes[at] == words.hashes)
    found = at[places]
    distinct, first = np.unique(found, return_index=True)
    wrong = [
        term
        for term, i in zip(distinct.tolist(), places[first].tolist())
        if words.data[words.starts[i] : words.starts[i] + words.lengths[i]].tobytes() != terms.names[term]
    ]
    if wrong:
        right = ~np.isin(found, wrong)
        places, found = places[right], found[right]
    return places, found


def _postings(sent):
    def run(batches):
        terms: Terms = sent.value
        for batch in batches:
            for first, block in blocks(batch.column(1)):
                words = Words(block)
                counts = words.counts()
                places, found = _occurrences(words, terms)
                key = words.rows()[places] * len(terms.names) + found
                key, tf = np.unique(key, return_counts=True)
                row, term = np.divmod(key, len(terms.names))
                ends = np.searchsorted(row, np.arange(len(block) + 1)).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (term, tf)
                ]
                made = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(block)), pa.array(counts, pa.int64()), *lists],
                    names=["doc_id", "n", "terms", "tfs"],
                )
                yield made.filter(pa.array(counts > 0))

    return run


@dataclass
class Query:
    """What every shard needs: term weights, items, and the statistics of all documents."""

    weight: np.ndarray
    items: list[np.ndarray]
    documents: int
    words: int
    k: int


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, documents: int, words: int) -> np.ndarray:
    m = 100 - 50 + (50 * n * documents) // words
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Shard:
    """Inverted lists of some documents, each by falling impact."""

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, query: Query):
        self.query, self.documents = query, len(lengths)
        doc = np.repeat(np.arange(len(lengths)), sizes)
        impact = impacts(tf, lengths[doc], query.weight[term], query.documents, query.words)
        order = np.lexsort((-impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.bounds = np.searchsorted(term[order], np.arange(len(query.weight) + 1))

    def best(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of the best k of this shard and all that tie with the last."""
        at, end = self.bounds[terms].copy(), self.bounds[terms + 1]
        used = at < end
        at, end = at[used], end[used]
        lower = np.zeros(self.documents, dtype=np.int64)
        unseen = np.ones((len(at), self.documents), dtype=bool)
        step = FIRST_STEP
        while True:
            frontier = np.zeros(len(at), dtype=np.int64)
            for i in np.flatnonzero(at < end).tolist():
                stop = min(int(at[i]) + step, int(end[i]))
                docs = self.doc[at[i] : stop]
                lower[docs] += self.impact[at[i] : stop]
                unseen[i, docs] = False
                at[i] = stop
                if stop < end[i]:
                    frontier[i] = self.impact[stop - 1]
            kth = 0
            if self.documents > self.query.k:
                kth = int(np.partition(lower, -self.query.k)[-self.query.k])
            open_lists = np.flatnonzero(frontier)
            wanted = np.flatnonzero(lower + frontier.sum() >= max(kth, 1))
            missing = frontier[open_lists] @ unseen[np.ix_(open_lists, wanted)]
            wanted, missing = (part[lower[wanted] + missing >= max(kth, 1)] for part in (wanted, missing))
            if not missing.any():
                return wanted, lower[wanted]
            step *= 2


def _search(sent):
    def run(batches):
        query: Query = sent.value
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            tf = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = batch.column(1).to_numpy(zero_copy_only=False)
            low = 0
            while low < len(sizes):
                base = int(ends[low] - sizes[low])
                high = max(low + 1, int(np.searchsorted(ends, base + SHARD_POSTINGS, side="right")))
                own = slice(base, int(ends[high - 1]))
                shard = Shard(lengths[low:high], sizes[low:high], term[own], tf[own], query)
                ids = batch.column(0).slice(low, high - low)
                for number, terms in enumerate(query.items):
                    docs, scores = shard.best(terms)
                    if len(docs):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(docs), number)), ids.take(pa.array(docs)), pa.array(scores)],
                            names=["item", "doc_id", "score"],
                        )
                low = high

    return run


def _search_block(rows: DataFrame, ids: list, terms: Terms, own: list, k: int, id_type) -> DataFrame:
    spark: SparkSession = rows.sparkSession
    context = spark.sparkContext
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        _postings(context.broadcast(terms)), f"doc_id {kind}, n bigint, terms array<int>, tfs array<int>"
    )
    found = stage(found, "postings")
    total = found.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    df = np.zeros(len(terms.names), dtype=np.int64)
    # One row per term of the block.
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weight = [floor(1000 * log((2 * total["documents"] + 2) / (2 * n + 1))) for n in df.tolist()]
    query = Query(np.array(weight, dtype=np.int64), own, total["documents"], max(1, total["words"]), k)
    best = found.mapInArrow(
        _search(context.broadcast(query)), f"item bigint, doc_id {kind}, score bigint"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(ids)), f"item bigint, item_id {id_type}")
    # At most BLOCK_TERMS items.
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score
    above 0, equal scores by rising doc_id (null first).

    Null and empty texts have no terms: such documents do not count and such items have
    no rows. Repeated documents are ranked each; repeated items (same id and text) once,
    items of one id with other texts each by itself. Whole texts are read; other columns
    are not.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = items.schema[item_id].dataType.simpleString()
    found = None
    for ids, terms, own in item_blocks(items, item_id, item_text, block_terms):
        part = _search_block(rows, ids, terms, own, k, id_type)
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = rows.schema["doc_id"].dataType.simpleString()
        schema = f"item_id {id_type}, rank int, doc_id {kind}, score bigint"
        found = docs.sparkSession.createDataFrame([], schema)
    return found
