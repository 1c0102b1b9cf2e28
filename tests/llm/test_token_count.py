from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from patronage.llm.token_count import PieceModel, token_counts
from tests.llm.helpers import awkward, empty, mirrored

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = PieceModel(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(text):
    return len(LIBRARY.encode(text or ""))


def check(df, docs):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())
    want = []
    for r in docs.select("doc_id", "text").collect():
        n = expected(r.text)
        want.append((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), n, n > 4096))
    assert got == sorted(want)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\taeinst.,<>|/x0A1é€"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_merging_matches_the_library(text):
    lead = MODEL.count("▁" + text.replace(" ", "▁")) if text else 0
    assert lead == expected(text)


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(token_counts(docs, PATH), docs)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    check(token_counts(docs, PATH), docs)


def test_a_small_memo_gives_the_same_counts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(50)
    check(token_counts(docs, PATH, memo_limit=10), docs)


def test_empty_table(spark):
    assert token_counts(empty(spark), PATH).collect() == []


@pytest.mark.parametrize("text", ["a" * 5000, "▁" * 40, "<0x0A> <s> </s>", "\n\n  \n x"])
def test_odd_texts(text):
    assert MODEL.count("▁" + text.replace(" ", "▁")) == expected(text)


def test_mirrored_words_are_told_apart(spark):
    rows = [(i, t) for i, t in enumerate(mirrored())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    check(token_counts(docs, PATH), docs)
