"""Hashed word shingles of the texts of a block."""

from __future__ import annotations

import numpy as np

from patronage.llm.text import Words, mix

SHINGLE = 5
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within each slice of ``bounds``, and the
    bounds of the result. A slice of fewer words, but not none, is one shingle."""
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(made)])
    if not ends[-1]:
        return np.zeros(0, np.uint64), ends
    starts = np.repeat(bounds[:-1] - ends[:-1], made) + np.arange(ends[-1])
    length = np.repeat(np.minimum(counts, size), made)
    out = length.astype(np.uint64)
    last = len(hashes) - 1
    for k in range(size):
        word = hashes[np.minimum(starts + k, last)]
        out = np.where(k < length, out * _STEP + word, out)
    return mix(out), ends


def counted(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each slice with their counts, and their bounds; in the order
    of their hashes within a slice."""
    rows = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    # Row number above, as much of the hash as fits below: one sort does both.
    bits = np.uint64(max(1, int(len(bounds) - 1).bit_length()))
    key = (rows << (np.uint64(64) - bits)) | (shingles >> bits)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(key)))
    own = shingles[order[first]]
    return own, counts, np.searchsorted(rows[order[first]], np.arange(len(bounds)))


def block_shingles(words: Words, size: int = SHINGLE):
    return counted(*shingle_hashes(words.hashes, words.bounds, size))
