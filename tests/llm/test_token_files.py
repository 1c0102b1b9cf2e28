from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from patronage.llm.chunks import ChunkEncoder
from patronage.llm.text import blocks
from patronage.llm.token_files import read_token_files, token_round_trip, write_token_files
from tests.llm.helpers import awkward, empty, mirrored

PATH = public_tokenizers.path("byte_bpe_50k.json")
NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
LIBRARY = {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in NAMES}
ENCODER = {n: ChunkEncoder(open(public_tokenizers.path(n), encoding="utf-8").read()) for n in NAMES}


def encoded(name, texts):
    out = []
    for _, block in blocks(pa.array(texts, pa.string())):
        ids, bounds = ENCODER[name].encode(block)
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    return out


LETTERS = st.one_of(
    st.sampled_from(" \n\t\r'.,!-_0123sStrevmld aébÀ×÷ŉſİßçñ\xa0\x85 　́\x1c<|>"),
    st.characters(exclude_categories=["Cs"]),
)


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(LETTERS, max_size=40), min_size=1, max_size=5))
def test_chunks_give_the_ids_of_whole_texts(name, texts):
    want = [e.ids for e in LIBRARY[name].encode_batch(texts, add_special_tokens=False)]
    assert encoded(name, texts) == want


@pytest.mark.parametrize("name", NAMES)
def test_special_strings(name):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y it's", "<|endoftext|", "we'll don't 'tis"]
    want = [e.ids for e in LIBRARY[name].encode_batch(texts, add_special_tokens=False)]
    assert encoded(name, texts) == want


def brute(rows, name, end):
    total, out = 0, []
    for doc, text in rows:
        ids = [*LIBRARY[name].encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, total, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        total += len(ids)
    return out


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = sorted(tuple(r) for r in token_round_trip(docs, PATH).collect())
    assert got == brute(rows, NAMES[0], 0)


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = token_round_trip(docs, PATH).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == [None, 1, 2, 2, *range(3, 13)]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert [tuple(r) for r in got] == brute([(i, texts[i]) for i in ids], NAMES[0], 0)


def test_layout(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    path = str(tmp_path / "tokens")
    write_token_files(docs, path, PATH)
    file = next((tmp_path / "tokens").glob("*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    kinds = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in str(kinds["ids.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in str(kinds["n_tokens"].encodings)
    assert all(c.has_offset_index for c in kinds.values())
    one = read_token_files(spark, path).where("doc_id = 7").select("n_tokens")
    plan = one._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_empty_table(spark):
    assert token_round_trip(empty(spark), PATH).collect() == []


def test_memo_can_be_forgotten():
    small = ChunkEncoder(open(PATH, encoding="utf-8").read(), limit=3)
    texts = ["one two three four", "five six one two"]
    for _, block in blocks(pa.array(texts)):
        ids, bounds = small.encode(block)
        ids2, _ = small.encode(block)
    assert np.array_equal(ids, ids2)
    assert ids[: bounds[1]].tolist() == LIBRARY[NAMES[0]].encode(texts[0]).ids


@pytest.mark.parametrize("name", NAMES)
def test_mirrored_chunks_are_told_apart(name):
    texts = [*mirrored(), *mirrored("ab", 1024)]
    assert encoded(name, texts) == [e.ids for e in LIBRARY[name].encode_batch(texts, add_special_tokens=False)]
