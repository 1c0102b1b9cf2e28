"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of one block of items reads the words of every document and keeps the
longest match that ends at each word. A match of ``window`` words, or of a whole
shorter item, is an occurrence. Before the automaton only runs of words are kept whose
neighbouring pairs all occur in items: a match cannot leave such a run.

Items are dealt into blocks of at most about ``block_words`` words, so what one pass
broadcasts has a fixed bound; each further block is another narrow pass over the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.text import Words, blocks, mix
from patronage.session import stage

WINDOW = 10
BLOCK_WORDS = 1_000_000


class ItemAutomaton:
    """Suffix automaton over word numbers, with the items of every window.

    ``windows`` maps a state to the items that have a window equal to the state's suffix
    of ``window`` words; ``short`` maps a state to items that as a whole are shorter.
    """

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int):
        self.window = window
        self.vocabulary = np.unique(np.concatenate([w for _, w in items] or [np.zeros(0, np.uint64)]))
        sequences = [(name, np.searchsorted(self.vocabulary, w).tolist()) for name, w in items if len(w)]
        pairs = [mix(w[:-1]) + w[1:] for _, w in items if len(w) > 1]
        self.pairs = np.unique(np.concatenate(pairs or [np.zeros(0, np.uint64)]))
        self.least = min([window, *(len(s) for _, s in sequences)])
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, sequence in sequences:
            self._add(sequence)
        self.windows: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, set]]] = {}
        whole: dict[int, tuple[int, set]] = {}
        for name, sequence in sequences:
            if len(sequence) < window:
                state = self._walk(sequence)
                whole.setdefault(state, (len(sequence), set()))[1].add(name)
            else:
                for state, matched in self._matches(sequence):
                    if matched == window:
                        self.windows.setdefault(state, set()).add(name)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            above = self.short.get(self.link[state], [])
            own = [whole[state]] if state in whole else []
            if above or own:
                self.short[state] = above + own

    def _add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            known = self.next[last].get(word)
            if known is not None and self.length[known] == self.length[last] + 1:
                last = known
                continue
            if known is not None:
                last = self._clone(last, word, known)
                continue
            state = self._state({}, self.length[last] + 1)
            at = last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = state
                at = self.link[at]
            if at < 0:
                self.link[state] = 0
            else:
                to = self.next[at][word]
                fits = self.length[to] == self.length[at] + 1
                self.link[state] = to if fits else self._clone(at, word, to)
            last = state

    def _state(self, edges: dict[int, int], length: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _clone(self, at: int, word: int, to: int) -> int:
        copy = self._state(dict(self.next[to]), self.length[at] + 1)
        self.link[copy], self.link[to] = self.link[to], copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _walk(self, sequence: list[int]) -> int:
        state = 0
        for word in sequence:
            state = self.next[state][word]
        return state

    def _matches(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """Per word: the state of the longest match that ends there, and its length. A
        match longer than ``window`` is cut to its last ``window`` words."""
        following, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for word in sequence:
            to = following[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(word)
            if to is None:
                yield 0, 0
                continue
            state, matched = to, matched + 1
            if matched >= window:
                matched = window
                while length[link[state]] >= window:
                    state = link[state]
            yield state, matched

    def occurrences(self, words: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """(first word, number of words, items) of every occurrence in one text's words."""
        if not len(words) or not len(self.vocabulary):
            return
        number = np.searchsorted(self.vocabulary, words)
        number[number == len(self.vocabulary)] = 0
        known = self.vocabulary[number] == words
        joined = np.zeros(len(words), dtype=bool)  # to the word before
        if len(self.pairs):
            pair = mix(words[:-1]) + words[1:]
            at = np.searchsorted(self.pairs, pair)
            at[at == len(self.pairs)] = 0
            joined[1:] = self.pairs[at] == pair
        heads = np.flatnonzero(known & ~joined)
        tails = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
        for head, tail in zip(heads.tolist(), tails.tolist()):
            if tail - head < self.least:
                continue
            for end, (state, matched) in enumerate(self._matches(number[head:tail].tolist()), head + 1):
                if matched == self.window and state in self.windows:
                    yield end - matched, matched, self.windows[state]
                for size, names in self.short.get(state, ()):
                    if size <= matched:
                        yield end - size, size, names


def _item_blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> list[DataFrame]:
    """Items in blocks of bounded size, cut by a hash of the item and so even; a longer
    single item makes its block longer. A null id counts as empty."""
    rows = items.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // (block_words * 4)
    place = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
    return [rows.where(place == part) for part in range(parts)]


def _automaton(block: DataFrame, window: int) -> ItemAutomaton:
    found = block.toArrow()
    names, sequences = found["id"].to_pylist(), []
    for chunk in found["text"].chunks:
        for _, texts in blocks(chunk):
            words = Words(texts)
            sequences += [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    return ItemAutomaton(list(zip(names, sequences)), window)


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _scan(automaton, keep_text: bool):
    """An Arrow task that adds one block's finds to the ``found`` column. Spans are
    (first word, one past the last) pairs, joined where they touch."""

    def run(batches):
        machine = automaton.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            before = batch.column(batch.schema.get_field_index("found"))
            n_words, spans, names = [], [], []
            for row, block in blocks(texts):
                words = Words(block)
                n_words += words.counts().tolist()
                for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                    old = before[row + i].as_py()
                    hit = [tuple(old["spans"][k : k + 2]) for k in range(0, len(old["spans"]), 2)] if old else []
                    items = set(old["items"]) if old else set()
                    for first, size, found in machine.occurrences(words.hashes[a:b]):
                        if hit and hit[-1][0] <= first <= hit[-1][1]:
                            hit[-1] = (hit[-1][0], max(hit[-1][1], first + size))
                        else:
                            hit.append((first, first + size))
                        items |= found
                    spans.append([x for pair in _joined(hit) for x in pair])
                    names.append(sorted(items))
            found = pa.StructArray.from_arrays(
                [
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(pa.int32())),
                    pa.array(names, pa.list_(pa.string())),
                ],
                names=["n_words", "spans", "items"],
            )
            after = texts if keep_text else pa.nulls(len(texts), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("row")), after, found],
                names=["row", "text", "found"],
            )

    return run


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
    keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of its other columns), ``text`` (null
    unless ``keep_text``) and ``found``: n_words, spans of hit words, sorted item names.

    Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. An
    item without words has no window. Null text has no words. Without items, or with
    empty tables, nothing is hit. Repeated rows are each scanned and stay.
    """
    spark = docs.sparkSession
    scanned = docs.select(
        F.struct(*[F.col(c) for c in docs.columns if c != text], F.lit(0).alias("_")).alias("row"),
        F.col(text).alias("text"),
        F.lit(None).cast(FOUND).alias("found"),
    )
    parts = _item_blocks(items, item_id, item_text, block_words)
    for number, part in enumerate(parts, 1):
        if number > 1:
            scanned = stage(scanned, "decontaminate")  # so that a worker holds one automaton
        automaton = spark.sparkContext.broadcast(_automaton(part, window))
        scanned = scanned.mapInArrow(
            _scan(automaton, keep_text or number < len(parts)), scanned.schema
        )
    return scanned


def _rows(found: DataFrame, columns: list[str], text: str) -> DataFrame:
    return found.select(
        *[(F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in columns]
    )


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Digest per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_contamination(
        docs.select(doc_id, text), items, text=text, keep_text=False, **options
    )
    spans = F.col("found.spans")
    # Ends minus starts of the flat list of pairs.
    hit = F.aggregate(
        F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return found.select(
        F.col(f"row.{doc_id}").alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _cut(max_span: int, max_share: float):
    """Drop a text of too large a hit share; cut longer hit spans out of the others."""

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found = batch.column(batch.schema.get_field_index("found"))
            out, keep = [], []
            for row, block in blocks(texts):
                words = Words(block)
                for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                    flat = found[row + i].as_py()["spans"]
                    pairs = list(zip(flat[::2], flat[1::2]))
                    share = sum(e - s for s, e in pairs) / max(1, b - a)
                    at, kept = int(block.offsets[i]), []
                    for s, e in pairs:
                        if e - s > max_span:
                            kept.append(block.text(at, int(words.starts[a + s])))
                            at = int(words.starts[a + e - 1] + words.lengths[a + e - 1])
                    kept.append(block.text(at, int(block.offsets[i + 1])))
                    out.append("".join(kept))
                    keep.append(share <= max_share)
            cut = pc.if_else(pc.is_null(texts), texts, pa.array(out, pa.string()))
            columns = [
                cut if name == "text" else batch.column(i)
                for i, name in enumerate(batch.schema.names)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(
                pa.array(keep, pa.bool_())
            )

    return run


def remove_contamination(
    docs: DataFrame,
    items: DataFrame,
    max_span: int = WINDOW - 1,
    max_share: float = 0.5,
    text: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without hit spans of more than ``max_span`` words; a document whose hit
    words are more than ``max_share`` of all goes. Null text stays null."""
    found = find_contamination(docs, items, text=text, **options)
    return _rows(found.mapInArrow(_cut(max_span, max_share), found.schema), docs.columns, text)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` in which no item window occurs."""
    found = find_contamination(docs, items, text=text, **options)
    return _rows(found.where(F.size("found.spans") == 0), docs.columns, text)
