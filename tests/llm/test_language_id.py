from __future__ import annotations

from patronage.llm.language_id import UNKNOWN, fit, identify_language, keep_identified
from tests.llm.helpers import awkward, empty, remainder


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in identify_language(docs).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    held = [r for r in rows if remainder(r.doc_id, 3) == 1]
    assert all(found[r.doc_id].held_out == (remainder(r.doc_id, 3) == 1) for r in rows)
    right = sum(found[r.doc_id].lang_pred == r.lang for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= found[r.doc_id].score <= 1 for r in rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = identify_language(docs).collect()
    assert len(rows) == docs.count()
    unknown = {r.doc_id for r in rows if r.lang_pred == UNKNOWN}
    assert unknown == {3, 4, 5, 6}
    assert all(r.score == 0 for r in rows if r.lang_pred == UNKNOWN)
    kept = keep_identified(docs)
    assert kept.columns == docs.columns
    assert not {r.doc_id for r in kept.collect()} & unknown


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id int, text string, lang string")
    assert [r.lang_pred for r in identify_language(docs).collect()] == [UNKNOWN]
    assert identify_language(empty(spark)).collect() == []


def test_word_rows_are_sums_of_log_probabilities():
    model = fit(["aa bb", "cc dd"], ["x", "y"])
    row = model.word_rows(["aa"])[0]
    assert row[0] > row[1] and row[2] == 1
    assert model.word_rows(["123"])[0][2] == 0
