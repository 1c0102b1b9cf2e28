"""Tokenizing whole texts by way of their distinct chunks.

A text is cut where the pre-tokenizer of the vocabulary always ends a piece: the ids of
a text are then the ids of its chunks, one after the other. Each distinct chunk goes
through the tokenizers library once per task and is looked up after that.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np

from patronage.llm.text import Block, Index, kept, ragged, segment_hashes

# Byte classes for cutting. Bytes of other kinds (0) never stand beside a cut.
OTHER, SPACE, BLANK, LETTER, DIGIT, MARK, QUOTE = range(7)
_KIND = np.full(256, MARK, dtype=np.uint8)
_KIND[32] = SPACE
_KIND[9:14] = BLANK
_KIND[28:32] = OTHER  # separators that some engines take for white space
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = LETTER
_KIND[39] = QUOTE
_ASCII_LETTER = _KIND == LETTER
_KIND[128:] = OTHER
# May a piece end between the two kinds? Never after a quote, which may begin a suffix.
_CUT = np.zeros((7, 7), dtype=bool)
_CUT[LETTER, [DIGIT, MARK, QUOTE]] = True
_CUT[DIGIT, [LETTER, MARK, QUOTE]] = True
_CUT[MARK, [LETTER, DIGIT]] = True
_CUT[LETTER : QUOTE + 1, SPACE : BLANK + 1] = True


def kinds(data: np.ndarray) -> np.ndarray:
    """Byte kinds; the second byte of U+00C0..U+017F counts as a letter unless it is one
    of the two signs there."""
    kind = _KIND[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    lead = lead[lead + 1 < len(data)]
    sign = (data[lead] == 0xC3) & ((data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7))
    kind[lead[~sign] + 1] = LETTER
    return kind


def cut_points(block: Block) -> np.ndarray:
    """True at the first byte of every chunk."""
    data = block.data
    kind = kinds(data)
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 1:
        lead = (data >= 0xC3) & (data <= 0xC5)
        cut[1:-1] = _CUT[kind[:-1], kind[1:]]
        # A single line feed or tab between visible characters is a piece of its own.
        after = kind.copy()
        after[lead] = LETTER
        visible = (kind >= LETTER) & (kind <= QUOTE)
        cut[2:-1] |= visible[:-2] & (kind[1:-1] == BLANK) & (after[2:] >= LETTER)
    cut[block.offsets] = True
    return cut[:-1] if len(data) else cut[:0]


def may_cut(spec: dict) -> bool:
    """Is the tokenizer of a kind for which the cuts hold? Others get whole texts."""
    first = spec.get("pre_tokenizer") or {}
    first = (first.get("pretokenizers") or [first])[0]
    normal = spec.get("normalizer") or {}
    steps = {n["type"] for n in normal.get("normalizers", [normal] if normal else [])}
    byte_level = first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
    pattern = str((first.get("pattern") or {}).get("Regex", ""))
    split = first.get("type") == "Split" and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in pattern
    return bool(byte_level and not steps) or bool(split and steps <= {"NFC", "Replace", "Lowercase"})


class _Lists:
    """Lists of ids by the hash of their chunk."""

    def __init__(self):
        self.index = Index()
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.at = np.zeros(1 << 12, dtype=np.int64)
        self.size = np.zeros(1 << 12, dtype=np.int64)

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Lists for sorted new hashes, one after another in ``ids``."""
        first, total = len(self.index), self.used + len(ids)
        if total > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(total, np.uint32)])
        if first + len(sizes) > len(self.at):
            room = np.zeros(first + len(sizes), np.int64)
            self.at = np.concatenate([self.at[:first], room])
            self.size = np.concatenate([self.size[:first], room])
        self.pool[self.used : total] = ids
        self.at[first : first + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.size[first : first + len(sizes)] = sizes
        self.used = total
        return self.index.add(hashes)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(numbers):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        sizes = self.size[numbers]
        return self.pool[ragged(self.at[numbers], sizes)], sizes


class ChunkEncoder:
    """Ids of the rows of a block, as the library gives them for whole texts.

    Chunks seen are kept in two generations of at most ``limit`` / 2 chunks and
    ``POOL`` ids each. New chunks that are a space and ASCII letters go through the
    library many at a time: a piece ends at each space, and the ids tell where.
    """

    POOL = 4_000_000
    JOINED = 2000

    def __init__(self, tokenizer: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer)
        self.library = Tokenizer.from_str(tokenizer)
        self.cuts = may_cut(spec)
        self.special = [t["content"].encode() for t in spec.get("added_tokens", ())]
        self.limit = max(1, limit // 2)
        self.young, self.old = _Lists(), _Lists()
        self.ending = self.weight = None
        suffix = spec.get("model", {}).get("end_of_word_suffix")
        names = self.library.get_vocab(with_added_tokens=True) if self.cuts else {}
        if suffix:
            self.ending = np.zeros(1 + max(names.values(), default=0), dtype=bool)
            self.ending[[i for name, i in names.items() if name.endswith(suffix)]] = True
        elif names:  # every character of a byte-level name stands for a byte
            self.weight = np.zeros(1 + max(names.values()), dtype=np.int64)
            self.weight[list(names.values())] = [len(name) for name in names]

    def _starts(self, block: Block) -> np.ndarray:
        if not self.cuts:
            return np.unique(block.offsets[:-1][np.diff(block.offsets) > 0])
        cut = cut_points(block)
        raw = block.data.tobytes() if self.special else b""
        for content in self.special:  # rows that may hold a special token go whole
            at = raw.find(content)
            while at >= 0:
                row = int(block.rows_of(np.array([at]))[0])
                cut[block.offsets[row] + 1 : block.offsets[row + 1]] = False
                at = raw.find(content, int(block.offsets[row + 1]))
        return np.flatnonzero(cut)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [f.ids for f in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _plain(self, block: Block, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which chunks are a space followed by ASCII letters only."""
        if self.ending is None and self.weight is None:
            return np.zeros(len(starts), dtype=bool)
        letter = np.concatenate([[0], np.cumsum(_ASCII_LETTER[block.data])])
        return (block.data[starts] == 32) & (lengths > 1) & (
            letter[starts + lengths] - letter[starts] == lengths - 1
        )

    def _learn(self, block: Block, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        plain = self._plain(block, starts, lengths)
        numbers = np.empty(len(starts), dtype=np.int64)
        own = np.flatnonzero(plain)
        if len(own):
            raw = block.data[ragged(starts[own], lengths[own])].tobytes().decode("ascii")
            edges = np.concatenate([[0], np.cumsum(lengths[own])])
            cuts = edges[np.append(np.arange(0, len(own), self.JOINED), len(own))].tolist()
            ids, _ = self._encoded([raw[a:b] for a, b in zip(cuts, cuts[1:])])
            if self.ending is not None:
                ends = np.flatnonzero(self.ending[ids]) + 1
            else:
                ends = np.searchsorted(np.cumsum(self.weight[ids]), edges[1:]) + 1
            numbers[own] = self.young.add(hashes[own], ids, np.diff(ends, prepend=0))
        own = np.flatnonzero(~plain)
        if len(own):
            texts = [block.text(a, a + n) for a, n in zip(starts[own].tolist(), lengths[own].tolist())]
            numbers[own] = self.young.add(hashes[own], *self._encoded(texts))
        return numbers

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block, and where each row's begin (one more entry than rows)."""
        starts = self._starts(block)
        lengths = np.diff(np.append(starts, len(block.data)))
        hashes = segment_hashes(block.data, starts, lengths)
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        size = len(self.young.index)
        if size and (size + len(unique) > self.limit or self.young.used > self.POOL):
            self.young, self.old = _Lists(), self.young
        number = self.young.index.find(unique)
        new = np.flatnonzero(number < 0)
        older = self.old.index.find(unique[new])
        back = new[older >= 0]
        if len(back):
            number[back] = self.young.add(unique[back], *self.old.ids(older[older >= 0]))
            new = new[older < 0]
        if len(new):
            at = first[new]
            number[new] = self._learn(block, starts[at], lengths[at], unique[new])
        ids, sizes = self.young.ids(number[inverse])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends[np.searchsorted(starts, block.offsets)]


def worker_encoder(tokenizer: str) -> ChunkEncoder:
    """The encoder of this Python worker: made once, and warm for its later tasks."""
    return kept("chunks", tokenizer, lambda: ChunkEncoder(tokenizer))


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` appended to every row."""
    grown = bounds + np.arange(len(bounds))
    out = np.empty(len(ids) + len(bounds) - 1, dtype=np.uint32)
    last = np.zeros(len(out), dtype=bool)
    last[grown[1:] - 1] = True
    out[last] = end
    out[~last] = ids
    return out, grown
