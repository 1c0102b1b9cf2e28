"""Vectorised work on the bytes of text columns inside Arrow tasks.

A text column arrives as one byte buffer with row offsets. Words and chunks are found
by byte class, named by a 64-bit hash, and costly work is done once per distinct word
of a block (``Memo``). Blocks are cut at about ``BLOCK`` bytes of text, so memory does
not depend on the size of an Arrow batch; a single longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 2_000_000
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Word bytes: digits, ASCII letters and every byte of a non-ASCII character.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True

# A fixed random value per byte; the hash of a segment is the sum of these values, each
# times a random odd number for its place (places that are powers of one base would give
# equal sums to known pairs of words).
_BYTE_VALUES = np.random.default_rng(20_240_101).integers(1, _MASK, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _places(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


_PLACES = _places(256)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every segment, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def segment_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte segment; lengths must be positive."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    longest = int(lengths.max())
    places = _PLACES if longest <= len(_PLACES) else _places(longest)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(first[-1] + lengths[-1])) - np.repeat(first, lengths)
    values = _BYTE_VALUES[data[inside + np.repeat(starts, lengths)]] * places[inside]
    return mix(np.add.reduceat(values, first) ^ lengths.astype(np.uint64))


class Block:
    """Some rows of a text column: ``data`` bytes, ``offsets`` of the rows in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def rows_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def row_bytes(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def text(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8", "replace")


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, Block]]:
    """Blocks of a string column with the row each begins at; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        at = offsets[row : end + 1]
        yield row, Block(data[at[0] : at[-1]], at - at[0])
        row = end


class Words:
    """The words of a block, in order: ``starts``, ``lengths``, ``hashes`` (lower case)
    and ``bounds``: the words of row i are bounds[i] to bounds[i + 1]."""

    def __init__(self, block: Block, lower: bool = True):
        self.data = LOWER[block.data] if lower else block.data
        inside = WORD[block.data]
        n = len(inside)
        edges = np.zeros(n + 1, dtype=bool)
        edges[block.offsets] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edges[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edges[1:n]
        self.starts = np.flatnonzero(first)
        self.lengths = np.flatnonzero(last) + 1 - self.starts
        self.hashes = segment_hashes(self.data, self.starts, self.lengths)
        self.bounds = np.searchsorted(self.starts, block.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def text(self, index: int) -> str:
        start = self.starts[index]
        return self.data[start : start + self.lengths[index]].tobytes().decode("utf-8", "replace")


class Index:
    """Numbers by 64-bit hash, in two sorted arrays."""

    def __init__(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of sorted hashes, -1 for those that are not there."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Give sorted new hashes the next numbers."""
        numbers = np.arange(len(self.hashes), len(self.hashes) + len(hashes))
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.numbers = np.insert(self.numbers, at, numbers)
        return numbers


class Memo:
    """Rows of numbers by hash, computed once per distinct segment and kept up to a bound.

    ``compute`` gets the texts of new segments and returns one row of ``width`` values
    for each. Two generations are kept: when the young one reaches half of ``limit`` it
    becomes the old one, and what is still asked for moves over, so that rare segments
    leave and common ones stay. 64-bit hashes name the segments: with a million of them
    in one worker the chance of any mix-up is below one in ten million.
    """

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int, dtype, limit: int = 400_000):
        self.compute, self.limit = compute, max(1, limit // 2)
        self.width, self.dtype = width, dtype
        self._start()
        self.old_index, self.old_rows = self.index, self.rows

    def _start(self) -> None:
        self.index = Index()
        self.rows = np.zeros((1024, self.width), dtype=self.dtype)

    def _add(self, hashes: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = len(self.index)
        if at + len(hashes) > len(self.rows):
            grown = np.zeros((2 * (at + len(hashes)), self.width), self.dtype)
            grown[:at] = self.rows[:at]
            self.rows = grown
        self.rows[at : at + len(hashes)] = values
        return self.index.add(hashes)

    def lookup(self, hashes: np.ndarray, text_of: Callable[[int], str]) -> np.ndarray:
        """The rows of all hashes; ``text_of`` gives the text of an index among them."""
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.index) and len(self.index) + len(unique) > self.limit:
            self.old_index, self.old_rows = self.index, self.rows
            self._start()
        found = self.index.find(unique)
        lost = np.flatnonzero(found < 0)
        older = self.old_index.find(unique[lost])
        back = lost[older >= 0]
        if len(back):
            found[back] = self._add(unique[back], self.old_rows[older[older >= 0]])
            lost = lost[older < 0]
        if len(lost):
            values = self.compute([text_of(i) for i in first[lost].tolist()])
            found[lost] = self._add(unique[lost], values)
        return self.rows[found[inverse]]


_KEPT: dict[str, tuple[object, object]] = {}


def kept(kind: str, key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept in this Python worker for later tasks with the same key;
    one object of each kind at a time."""
    if kind not in _KEPT or _KEPT[kind][0] != key:
        _KEPT[kind] = (key, make())
    return _KEPT[kind][1]


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive slices bounds[i]:bounds[i + 1] along the first axis."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.result_type(values.dtype, np.int64))
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
