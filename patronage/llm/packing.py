"""Packing documents into sequences by patterns of few lengths.

Tokenizing gives a length histogram, which has one entry per length whatever the number
of documents. Lengths are put into classes; all patterns of few classes that fill a
sequence are enumerated, and non-negative least squares fits how often each is used.
Rounded down, the patterns place documents, the last slot of each by the room that is
really left; the other documents go, longest first, to where they fit best.

The plan has a bounded size. Every piece has a number within its length, and that
number alone finds its place in the plan: no document passes through the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.chunks import with_end, worker_encoder
from patronage.llm.text import blocks
from patronage.session import stage

CAPACITY = 4096
CLASSES = 64
PATTERN_SIZE = 4


def patterns(total: int, parts: int, most: int | None = None) -> list[tuple[int, ...]]:
    """All non-increasing tuples of at most ``parts`` positive numbers with that sum."""
    if total == 0:
        return [()]
    if parts == 0:
        return []
    return [
        (first, *rest)
        for first in range(min(total, most or total), 0, -1)
        if first * parts >= total
        for rest in patterns(total - first, parts - 1, first)
    ]


def non_negative_fit(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """min |matrix x - target| over x >= 0 by an active set of columns."""
    columns = matrix.shape[1]
    x, active = np.zeros(columns), np.zeros(columns, dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(3 * len(target) + 10):
        slope = matrix.T @ (target - matrix @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance:
            break
        active[best] = True
        while True:
            own = np.flatnonzero(active)
            solved = np.linalg.lstsq(matrix[:, own], target, rcond=None)[0]
            if solved.min() > 0:
                x[:] = 0
                x[own] = solved
                break
            low = solved <= 0
            step = (x[own][low] / np.maximum(x[own][low] - solved[low], 1e-300)).min()
            x[own] += step * (solved - x[own])
            active[own[low & (x[own] <= tolerance)]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


class Plan:
    """Runs (length, first rank, documents per sequence, first sequence, offset): the
    rank-th piece of a length lies in the run that holds its rank."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.rank: dict[int, int] = defaultdict(int)
        self.room: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []

    def _open(self, room: int, first: int, count: int) -> None:
        if count and room:
            if room not in self.room:
                self.room[room] = []
                insort(self.rooms, room)
            self.room[room].append((first, count))

    def _put(self, length: int, each: int, first: int, count: int, room: int) -> None:
        """``each`` documents of one length into ``count`` sequences with equal room."""
        self.runs.append((length, self.rank[length], each, first, self.capacity - room))
        self.rank[length] += each * count
        self._open(room - each * length, first, count)

    def use_pattern(self, lengths: list[int], count: int) -> None:
        """``count`` new sequences that begin with the given lengths."""
        offset = 0
        for length in lengths:
            self.runs.append((length, self.rank[length], 1, self.sequences, offset))
            self.rank[length] += count
            offset += length
        self._open(self.capacity - offset, self.sequences, count)
        self.sequences += count

    def best_fit(self, length: int, count: int) -> None:
        """Place ``count`` documents, each time where the least room is left over."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                new = max(1, count // each)
                first, room = self.sequences, self.capacity
                self.sequences += new
                self._put(length, min(each, count), first, new, room)
                count -= min(each, count) * new
                continue
            room = self.rooms[at]
            first, there = self.room[room].pop()
            if not self.room[room]:
                del self.room[room], self.rooms[at]
            each = min(room // length, count)
            used = min(there, count // each)
            self._open(room, first + used, there - used)
            self._put(length, each, first, used, room)
            count -= each * used


def make_plan(
    histogram: dict[int, int],
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    pattern_size: int = PATTERN_SIZE,
) -> Plan:
    """The plan for so many pieces of each length (1 to ``capacity``). With few pieces,
    rounding the patterns may cost more than they gain: then all go by best fit."""
    plan, plain = _pattern_plan(histogram, capacity, classes, pattern_size), Plan(capacity)
    for length in sorted(histogram, reverse=True):
        plain.best_fit(length, histogram[length])
    return plain if plain.sequences < plan.sequences else plan


def _pattern_plan(histogram: dict[int, int], capacity: int, classes: int, pattern_size: int) -> Plan:
    plan = Plan(capacity)
    left = {length: count for length, count in histogram.items() if count}
    width = -(-capacity // classes)
    classes = capacity // width  # a pattern of full classes must fit
    members = defaultdict(list)
    for length in sorted(left, reverse=True):
        code = -(-length // width)
        if code <= classes:
            members[code].append(length)
    target = np.zeros(classes)
    for code, lengths in members.items():
        target[code - 1] = sum(left[n] for n in lengths)
    chosen = [p for p in patterns(classes, pattern_size) if all(target[c - 1] for c in p)]
    if chosen:
        matrix = np.zeros((classes, len(chosen)))
        for j, pattern in enumerate(chosen):
            for code in pattern:
                matrix[code - 1, j] += 1
        there = sorted(left)
        for pattern, times in zip(chosen, np.floor(non_negative_fit(matrix, target)).astype(int)):
            _use(plan, pattern, int(times), members, left, there)
    for length in sorted(left, reverse=True):
        if left[length]:
            plan.best_fit(length, left[length])
    return plan


def _use(plan: Plan, pattern, times: int, members, left: dict[int, int], there: list[int]) -> None:
    """Begin ``times`` sequences with the lengths of a pattern's classes, longest first.
    The last slot takes the longest length of any class that still fits, so the room lost
    to rounding up the others is used. Stops early when a class has run out."""
    while times > 0:
        kind: list[int] = []
        for code in pattern[:-1]:
            length = next((n for n in members[code] if left[n] > kind.count(n)), None)
            if length is None:
                return
            kind.append(length)
        at = bisect_right(there, plan.capacity - sum(kind)) - 1
        while at >= 0 and left[there[at]] <= kind.count(there[at]):
            if left[there[at]] == 0:
                del there[at]
            at -= 1
        if at < 0:
            return
        kind.append(there[at])
        count = min([times, *(left[n] // kind.count(n) for n in kind)])
        plan.use_pattern(kind, count)
        for length in kind:
            left[length] -= count
        times -= count


def _pieces(tokenizer, end: int, capacity: int):
    def run(batches):
        encoder = worker_encoder(tokenizer.value)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for row, block in blocks(batch.column(1)):
                ids, bounds = with_end(*encoder.encode(block), end)
                sizes = np.diff(bounds)
                parts = -(-sizes // capacity)
                of = np.repeat(np.arange(len(block)), parts)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(sizes[of] - start, capacity)
                raw, first = memoryview(ids.astype("<u4").tobytes()), bounds[of] + start
                sums = [
                    zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())
                ]
                # The number of each piece among those of its length in this task.
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                head = np.searchsorted(ordered, ordered)
                number = np.empty(len(of), dtype=np.int64)
                number[order] = np.arange(len(of)) - head + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(block)).take(pa.array(of)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                        pa.array(np.full(len(of), task, dtype=np.int32)),
                        pa.array(number),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"],
                )

    return run


def _place(plan):
    def run(batches):
        runs = plan.value
        key = (runs[:, 0] << 48) + runs[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            own = runs[np.searchsorted(key, (length << 48) + rank, side="right") - 1] if len(key) else runs
            inside = rank - own[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(5)],
                    pa.array(own[:, 3] + inside // own[:, 2]),
                    pa.array(own[:, 4] + inside % own[:, 2] * length),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end: int = 1,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end``; only documents of more than ``capacity`` ids are
    cut. Null text counts as empty and gives the end id. Repeated rows are packed each.
    An empty table gives no sequence. Other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = stage(
        rows.mapInArrow(
            _pieces(tokenizer, end, capacity), f"{columns}, task int, number bigint"
        ),
        "pieces",
    )
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("count"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    # At most one row per length.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    runs = np.array(sorted(make_plan(histogram, capacity).runs), dtype=np.int64).reshape(-1, 5)
    ranked = pieces.join(bases, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("base")).alias("rank")
    )
    return ranked.mapInArrow(
        _place(spark.sparkContext.broadcast(runs)), f"{columns}, sequence_id bigint, offset bigint"
    )
