"""Token counts by byte-pair merging with a heap and a linked list.

The count is the number of initial symbols less the number of merges; no identifiers
are made. Piece ranks come from a sentencepiece model. Texts are cut where no merge can
reach across, and every distinct chunk is merged once in a Python worker.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.text import Block, Memo, blocks, kept, row_sums, segment_hashes

SPACE = "▁"  # how the model writes a space


class PieceModel:
    """Merge ranks and single characters of a sentencepiece BPE model with byte fallback."""

    def __init__(self, model: str | bytes):
        import sentencepiece

        load = {"model_proto": model} if isinstance(model, bytes) else {"model_file": model}
        pieces = sentencepiece.SentencePieceProcessor(**load)
        special = lambda i: (
            pieces.is_byte(i) or pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i)
        )
        own = [i for i in range(pieces.get_piece_size()) if not special(i)]
        self.rank = {pieces.id_to_piece(i): (-pieces.get_score(i), i) for i in own}
        order = sorted(self.rank, key=self.rank.__getitem__)
        self.rank = {piece: n for n, piece in enumerate(order)}
        # Where a text may be cut: before a space after another character, if no piece
        # holds a space past its first other character; around line feeds likewise.
        self.cut_spaces = not any(SPACE in p.lstrip(SPACE) for p in self.rank)
        self.cut_lines = not any("\n" in p for p in self.rank if len(p) > 1)

    def count(self, text: str) -> int:
        """Tokens of ``text``, in which spaces are already written as the model does."""
        rank = self.rank
        symbols = list(text)
        initial = sum(1 if c in rank else len(c.encode("utf-8")) for c in symbols)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            pair = rank.get(symbols[i] + symbols[i + 1])
            if pair is not None:
                heap.append((pair, i, symbols[i] + symbols[i + 1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, left, piece = heapq.heappop(heap)
            right = after[left]
            # A stale entry: a side was merged since.
            if not symbols[left] or right < 0 or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = end = after[right]
            merges += 1
            if end >= 0:
                before[end] = left
                pair = rank.get(piece + symbols[end])
                if pair is not None:
                    heapq.heappush(heap, (pair, left, piece + symbols[end]))
            front = before[left]
            if front >= 0:
                pair = rank.get(symbols[front] + piece)
                if pair is not None:
                    heapq.heappush(heap, (pair, front, symbols[front] + piece))
        return initial - merges

    def counts(self, chunks: list[str]) -> np.ndarray:
        found = [self.count(c.replace(" ", SPACE)) for c in chunks]
        return np.array(found, dtype=np.int64).reshape(-1, 1)

    def starts(self, data: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """First bytes of chunks; ``heads`` are the first bytes of texts."""
        cut = np.zeros(len(data), dtype=bool)
        if len(data) > 1:
            here, prior = data[1:], data[:-1]
            if self.cut_spaces:
                # 0x81 may end a written space character: no cut after it.
                cut[1:] |= (here == 32) & (prior != 32) & (prior != 0x81)
            if self.cut_lines:
                cut[1:] |= (here == 10) | (prior == 10)
        cut[heads] = True
        return np.flatnonzero(cut)


def _with_lead(block: Block) -> Block:
    """The block with a space before every text that is not empty."""
    sizes = np.diff(block.offsets)
    full = np.flatnonzero(sizes)
    data = np.insert(block.data, block.offsets[full], 32) if len(full) else block.data
    return Block(data, np.concatenate([[0], np.cumsum(sizes + (sizes > 0))]))


def block_counts(model: PieceModel, memo: Memo, block: Block) -> np.ndarray:
    led = _with_lead(block)
    heads = led.offsets[:-1][np.diff(led.offsets) > 0]
    starts = model.starts(led.data, heads)
    lengths = np.diff(np.append(starts, len(led.data)))
    hashes = segment_hashes(led.data, starts, lengths)
    text_of = lambda i: led.text(starts[i], starts[i] + lengths[i])
    values = memo.lookup(hashes, text_of)[:, 0]
    return row_sums(values, np.searchsorted(starts, led.offsets))


def _with_memo(model: bytes, limit: int) -> tuple[PieceModel, Memo]:
    pieces = PieceModel(model)
    return pieces, Memo(pieces.counts, 1, np.int64, limit)


def _count(model, memo_limit: int):
    def run(batches):
        pieces, memo = kept("pieces", (model.value, memo_limit), lambda: _with_memo(model.value, memo_limit))
        for batch in batches:
            sizes, counts = [], []
            for _, block in blocks(batch.column(1)):
                sizes.append(np.diff(block.offsets))
                counts.append(block_counts(pieces, memo, block))
            join = lambda parts: np.concatenate(parts or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(join(sizes)), pa.array(join(counts))],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    model_path: str,
    limit: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
    memo_limit: int = 400_000,
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Null text counts as empty, and empty text has no tokens. Repeated rows each give a
    row; other columns are not read. A long text without a place to cut is merged whole
    in n log n steps. ``model_path`` is read on the driver and sent to the tasks.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(
        _count(model, memo_limit), f"doc_id {kind}, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
