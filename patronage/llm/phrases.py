"""Words of pieces of text, and counts of word sequences, for phrase mining.

Text is lower-cased (A-Z), cut into pieces at stops and line ends, and pieces into words
at spaces and tabs. A sequence of words has a 64-bit hash into which its group (the
language) enters; hashes choose what to count, and the counts themselves are of the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from patronage.llm.text import BLOCK, LOWER, Block, blocks, mix, segment_hashes

# Fixed values of the contract: where pieces end, and what stands between words.
STOPS = b".,;:!?\x0a\x0b\x0c\x0d"
GAPS = b" \t"
_STOP = np.zeros(256, dtype=bool)
_STOP[list(STOPS)] = True
_WORD = ~_STOP
_WORD[list(GAPS)] = False
_NEXT = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The words of a block: ``starts``, ``lengths``, ``hashes`` (never 0), ``rows``, and
    ``follows``: does the word continue the piece of the word before it?"""

    def __init__(self, block: Block):
        data = LOWER[block.data]
        inside = _WORD[data]
        n = len(inside)
        edges = np.zeros(n + 1, dtype=bool)
        edges[block.offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edges[1:n]
        last[:-1] &= ~inside[1:] | edges[1:n]
        self.starts = np.flatnonzero(first)
        self.lengths = np.flatnonzero(last) + 1 - self.starts
        self.hashes = segment_hashes(data, self.starts, self.lengths) | np.uint64(1)
        self.rows = block.rows_of(self.starts)
        stops = np.cumsum(_STOP[data], dtype=np.int64)[self.starts]
        self.follows = np.zeros(len(self.starts), dtype=bool)
        self.follows[1:] = (stops[1:] == stops[:-1]) & (self.rows[1:] == self.rows[:-1])
        self.raw = data.tobytes()

    def begin(self, groups: np.ndarray) -> np.ndarray:
        """Hashes of the single words within the group of their row."""
        return mix(self.hashes ^ groups[self.rows])

    def extend(self, hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Hashes of sequences after one more word each."""
        return mix(hashes * _NEXT + self.hashes[words])

    def text(self, first: int, size: int) -> bytes:
        """``size`` words from ``first`` on, with single spaces between."""
        last = first + size - 1
        return b" ".join(self.raw[self.starts[first] : self.starts[last] + self.lengths[last]].split())

    def texts(self, first: np.ndarray, size: int) -> list[bytes]:
        last = first + size - 1
        ends = self.starts[last] + self.lengths[last]
        raw = self.raw
        return [b" ".join(raw[a:b].split()) for a, b in zip(self.starts[first].tolist(), ends.tolist())]


def among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return wanted[at] == values


def group_hashes(names: pa.Array) -> np.ndarray:
    """One number per row that stands for its group name."""
    coded = names.dictionary_encode()
    bytes_of = [n.as_py().encode("utf-8") for n in coded.dictionary]
    sizes = np.array([len(b) + 1 for b in bytes_of], dtype=np.int64)
    data = np.frombuffer(b"".join(b + b"\0" for b in bytes_of), dtype=np.uint8)
    hashes = segment_hashes(data, np.cumsum(sizes) - sizes, sizes)
    return hashes[coded.indices.to_numpy(zero_copy_only=False)]


def pieces_of(batches):
    """(group names, group hashes, pieces) per block of batches that hold group, text."""
    for batch in batches:
        groups = group_hashes(batch.column(0))
        for first, block in blocks(batch.column(1), BLOCK // 2):
            own = slice(first, first + len(block))
            yield batch.column(0).slice(first, len(block)), groups[own], Pieces(block)


def counted(hashes: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """(index of one entry, count, then least and greatest of each other array) per
    distinct hash, in the order of the hashes."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(order) else order
    out = [order[heads], np.diff(np.append(heads, len(order)))]
    for values in others:
        values = values[order]
        for reduce in (np.minimum, np.maximum):
            out.append(reduce.reduceat(values, heads) if len(heads) else values)
    return tuple(out)


WORD_COUNTS = "lang string, word string, h bigint, n bigint"


def word_counts(batches):
    for names, groups, pieces in pieces_of(batches):
        hashes = pieces.begin(groups)
        first, count = counted(hashes)
        yield pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(pieces.rows[first])),
                pa.array(pieces.texts(first, 1), pa.binary()).cast(pa.string()),
                pa.array(hashes[first].view(np.int64)),
                pa.array(count),
            ],
            names=["lang", "word", "h", "n"],
        )


EXTENSIONS = (
    "lang string, phrase string, h bigint, size int, n bigint, "
    "next_low bigint, next_high bigint, before_low bigint, before_high bigint"
)


def extensions(sent, size: int, longest: int):
    """Counts of sequences of ``size`` + 1 to ``longest`` words that begin with a wanted
    sequence of ``size`` words. ``sent`` holds (wanted hashes, hashes of the words that
    may follow, or None for all). With each count go the least and the greatest hash of
    the word after it and of the word before it, 0 at the end of a piece."""

    def run(batches):
        wanted, known = sent.value
        for names, groups, pieces in pieces_of(batches):
            words = len(pieces.starts)
            alone = pieces.begin(groups)
            usable = pieces.follows if known is None else pieces.follows & among(alone, known)
            after = np.append(np.where(pieces.follows, pieces.hashes, 0)[1:], np.zeros(1 + longest, np.uint64))
            before = np.where(pieces.follows, np.append(np.zeros(1, np.uint64), pieces.hashes[:-1]), 0)[:words]
            at, hashes = np.arange(words), alone
            for step in range(1, size):
                at, hashes = _longer(pieces, at, hashes, step, usable)
            hit = among(hashes, wanted)
            at, hashes = at[hit], hashes[hit]
            for step in range(size, longest):
                at, hashes = _longer(pieces, at, hashes, step, usable)
                first, count, *ends = counted(hashes, after[at + step].view(np.int64), before[at].view(np.int64))
                if not len(first):
                    break
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(pieces.rows[at[first]])),
                        pa.array(pieces.texts(at[first], step + 1), pa.binary()).cast(pa.string()),
                        pa.array(hashes[first].view(np.int64)),
                        pa.array(np.full(len(first), step + 1, np.int32)),
                        pa.array(count),
                        *map(pa.array, ends),
                    ],
                    names=["lang", "phrase", "h", "size", "n", "next_low", "next_high", "before_low", "before_high"],
                )

    return run


def _longer(pieces: Pieces, at: np.ndarray, hashes: np.ndarray, step: int, usable: np.ndarray):
    """The sequences that go on with a usable word ``step`` places after their first."""
    inside = at + step < len(pieces.starts)
    at, hashes = at[inside], hashes[inside]
    goes_on = usable[at + step]
    at = at[goes_on]
    return at, pieces.extend(hashes[goes_on], at + step)


SEQUENCE_COUNTS = "lang string, phrase string, n bigint"


def sequence_counts(sent, longest: int):
    """Counts of wanted sequences of 2 to ``longest`` words; ``sent`` holds their hashes,
    and those of all that they begin with."""

    def run(batches):
        wanted, prefixes = sent.value
        for names, groups, pieces in pieces_of(batches):
            at, hashes = np.arange(len(pieces.starts)), pieces.begin(groups)
            for step in range(1, longest):
                on = among(hashes, prefixes)
                at, hashes = _longer(pieces, at[on], hashes[on], step, pieces.follows)
                own = np.flatnonzero(among(hashes, wanted))
                first, count = counted(hashes[own])
                if len(first):
                    first = own[first]
                    yield pa.RecordBatch.from_arrays(
                        [
                            names.take(pa.array(pieces.rows[at[first]])),
                            pa.array(pieces.texts(at[first], step + 1), pa.binary()).cast(pa.string()),
                            pa.array(count),
                        ],
                        names=["lang", "phrase", "n"],
                    )

    return run


def sequence_hashes(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Hashes of (group, words with single spaces between), as found in texts."""
    if not pairs:
        return np.zeros(0, np.uint64)
    groups = group_hashes(pa.array([g for g, _ in pairs], pa.string()))
    out = np.empty(len(pairs), np.uint64)
    for first, block in blocks(pa.array([p for _, p in pairs], pa.string())):
        pieces = Pieces(block)
        own = slice(first, first + len(block))
        alone = pieces.begin(groups[own])
        heads = np.searchsorted(pieces.rows, np.arange(len(block)))
        sizes = np.diff(np.append(heads, len(pieces.rows)))
        hashes = alone[heads]
        for step in range(1, int(sizes.max())):
            on = np.flatnonzero(sizes > step)
            hashes[on] = pieces.extend(hashes[on], heads[on] + step)
        out[own] = hashes
    return out
