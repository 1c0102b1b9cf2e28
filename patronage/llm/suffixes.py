"""Anchored suffixes of texts, their packing into buckets, and their local order.

A window is a string of ``span`` bytes. Every window picks an anchor inside itself: the
first of its eight-byte grams with the least hash. Equal windows pick the same anchor, so
the suffixes that begin at anchors stand for all windows: one record holds the suffix, the
bytes left of it, and the run of windows that picked it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from patronage.llm.text import Block, mix, ragged

GRAM = 8
PART = 1_000_000  # window starts handled at once
_LOW = np.uint64(0xFFFFFFFF)


@dataclass
class Records:
    """Arrays with one entry per record, and the bytes of all records one after another."""

    row: np.ndarray  # number of the text
    start: np.ndarray  # first byte of the first window, counted in the text
    left: np.ndarray  # bytes before the anchor
    count: np.ndarray  # windows; the bytes are count + span - 1
    data: np.ndarray

    def take(self, index: np.ndarray, span: int) -> Records:
        sizes = self.count.astype(np.int64) + span - 1
        first = np.cumsum(sizes) - sizes
        data = gathered(self.data, first[index], sizes[index])
        return Records(self.row[index], self.start[index], self.left[index], self.count[index], data)

    def __len__(self) -> int:
        return len(self.row)


def gathered(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of segments one after another; places are made for some at a time."""
    step = 20_000
    parts = [data[ragged(first[i : i + step], sizes[i : i + step])] for i in range(0, len(first), step)]
    return np.concatenate(parts or [data[:0]])


def joined(parts: list[Records]) -> Records:
    names = ("row", "start", "left", "count", "data")
    return Records(*[np.concatenate([getattr(p, n) for p in parts]) for n in names])


def anchored(block: Block, span: int):
    """Records of all windows of a block, in parts of bounded size; ``row`` is the number
    within the block. Windows do not cross texts."""
    reach = span - GRAM + 1
    offsets = block.offsets
    for low in range(0, len(block.data), PART):
        data = block.data[low : low + PART + span - 1]
        n = len(data) - span + 1
        if n <= 0:
            break
        grams = np.ndarray((len(data) - GRAM + 1,), dtype="<u8", buffer=data.tobytes(), strides=(1,))
        least = (mix(grams.copy()) & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while 2 * size <= reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < reach:
            least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
        anchor = (least & _LOW).astype(np.int64)
        row = block.rows_of(np.arange(low, low + n))
        valid = np.arange(low, low + n) + span <= offsets[row + 1]
        head = valid.copy()
        head[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(head)
        if not len(at):
            continue
        # Windows without a record end a run as well as the next head does.
        ends = np.flatnonzero(np.append(head | ~valid, True))
        count = ends[np.searchsorted(ends, at, side="right")] - at
        bytes_of = data[ragged(at, count + span - 1)]
        yield Records(
            row[at], at + low - offsets[row[at]], (anchor[at] - at).astype(np.uint8), count.astype(np.uint8), bytes_of
        )


def padded(data: np.ndarray, first: np.ndarray, sizes: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """A row of ``width`` bytes per segment, with zeros past its size; a step of -1 reads
    backwards from ``first``."""
    out = np.zeros((len(first), width), dtype=np.uint8)
    places = np.arange(width)
    for low in range(0, len(first), 50_000):
        own = slice(low, low + 50_000)
        inside = places < sizes[own, None]
        out[own][inside] = data[(first[own, None] + step * places)[inside]]
    return out


def right_parts(records: Records, span: int) -> np.ndarray:
    """The bytes from the anchor on, ``span`` at most, padded to a multiple of 8."""
    sizes = records.count.astype(np.int64) + span - 1
    first = np.cumsum(sizes) - sizes
    left = records.left.astype(np.int64)
    return padded(records.data, first + left, sizes - left, -(-span // 8) * 8)


def left_parts(records: Records, span: int) -> np.ndarray:
    """The bytes before the anchor, read backwards, padded to a multiple of 8."""
    sizes = records.count.astype(np.int64) + span - 1
    first = np.cumsum(sizes) - sizes
    left = records.left.astype(np.int64)
    return padded(records.data, first + left - 1, left, -(-(span - GRAM) // 8) * 8, -1)


def sort_keys(right: np.ndarray, owner: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Fixed-width keys: right part, then owner and place, so that equal suffixes of many
    texts can be dealt apart."""
    tail = np.empty((len(right), 2), dtype=">u8")
    tail[:, 0] = owner.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    tail[:, 1] = start.astype(np.uint64)
    whole = np.concatenate([right, tail.view(np.uint8).reshape(len(right), 16)], axis=1)
    return np.ascontiguousarray(whole).view(f"S{whole.shape[1]}").ravel()


def characters(parts: np.ndarray) -> np.ndarray:
    """Rows of bytes as columns of eight-byte characters that compare like the bytes."""
    return parts.view(">u8").astype(np.uint64)


SMALL = 4096


def multikey_order(columns: np.ndarray) -> np.ndarray:
    """The order of rows of characters by multikey quicksort.

    Large segments are split in three around a pivot character: less and greater go on
    with the same character, equal with the next one. Small segments are refined
    together, a character at a time.
    """
    n, depth_end = columns.shape
    order = np.arange(n)
    stack, small = [(0, n, 0)], [[] for _ in range(depth_end)]
    while stack:
        low, high, depth = stack.pop()
        if depth == depth_end or high - low < 2:
            continue
        if high - low <= SMALL:
            small[depth].append(np.array([[low, high]]))
            continue
        own = order[low:high]
        values = columns[own, depth]
        pivot = np.sort(values[:: max(1, len(values) // 101)])[50]
        less, equal = values < pivot, values == pivot
        order[low:high] = np.concatenate([own[less], own[equal], own[~(less | equal)]])
        a = low + int(less.sum())
        b = a + int(equal.sum())
        stack += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    for depth in range(depth_end):
        if small[depth]:
            equal = _refine(order, columns[:, depth], np.concatenate(small[depth]))
            if depth + 1 < depth_end and len(equal):
                small[depth + 1].append(equal)
    return order


def _refine(order: np.ndarray, column: np.ndarray, segments: np.ndarray) -> np.ndarray:
    """Sort inside segments by one character; the segments of what is still equal."""
    sizes = segments[:, 1] - segments[:, 0]
    at = ragged(segments[:, 0], sizes)
    segment = np.repeat(np.arange(len(segments)), sizes)
    own = order[at]
    values = column[own]
    moved = np.lexsort((values, segment))
    order[at] = own[moved]
    values = values[moved]
    same = (segment[1:] == segment[:-1]) & (values[1:] == values[:-1])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    return np.stack([at[edges[::2]], at[edges[1::2]] + 1], axis=1)


def common_prefixes(parts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Equal leading bytes of every row with the one before it in the order; first 0."""
    out = np.zeros(len(order), dtype=np.int64)
    width = parts.shape[1]
    for low in range(1, len(order), 200_000):
        a, b = order[low - 1 : low + 199_999], order[low : low + 200_000]
        a = a[: len(b)]
        unlike = parts[a] != parts[b]
        out[low : low + len(b)] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), width)
    return out


def shared_with(parts: np.ndarray, other: bytes | None) -> np.ndarray:
    """Equal leading bytes of every row with one string of the same width."""
    if other is None:
        return np.zeros(len(parts), dtype=np.int64)
    unlike = parts != np.frombuffer(other, dtype=np.uint8)[: parts.shape[1]]
    return np.where(unlike.any(axis=1), unlike.argmax(axis=1), parts.shape[1])
