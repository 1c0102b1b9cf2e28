from __future__ import annotations

import hashlib
import random

from patronage.llm.decontaminate import (
    ItemAutomaton,
    contamination,
    drop_contaminated,
    remove_contamination,
)
from tests.llm.helpers import BASE, awkward, empty, mirrored, words


def brute(docs, items, window=10):
    grams: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if k else ():
            grams.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                found = grams.get(tuple(w[i : i + k]))
                if found:
                    hit.update(range(i, i + k))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out)


def got(df):
    return sorted(
        (str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
        for r in df.collect()
    )


def plain(df, key):
    return [(r[0], r[1]) for r in df.select(key, "text").collect()]


def test_whole_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    assert got(contamination(docs, items)) == brute(plain(docs, "doc_id"), plain(items, "item_id"))


def test_awkward_rows_and_short_items(spark):
    rows = [(1, BASE), (2, "lazy dog"), (3, None), (4, "!!"), (None, "the river"), (5, "now"), (5, "brown fox jumps")]
    items = spark.createDataFrame(rows, "item_id int, text string")
    docs = awkward(spark)
    assert got(contamination(docs, items)) == brute(plain(docs, "doc_id"), rows)


def test_random_small_vocabulary(spark):
    pick = random.Random(7)
    text = lambda n: " ".join(pick.choice("abc") for _ in range(n))
    items = [(i, text(pick.randint(0, 8))) for i in range(12)]
    docs = [(i, text(pick.randint(0, 60))) for i in range(80)]
    a = spark.createDataFrame(docs, "doc_id int, text string")
    b = spark.createDataFrame(items, "item_id int, text string")
    for window in (1, 3, 5):
        assert got(contamination(a, b, window=window)) == brute(docs, items, window)


def test_blocks_of_items_give_the_same(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    whole = got(contamination(docs, items))
    assert got(contamination(docs, items, block_words=600)) == whole


def test_removal_and_dropping(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id int, text string")
    text = "Before it. One two three four five six seven eight nine ten ELEVEN! After it comes more text, and more and more of it."
    docs = spark.createDataFrame(
        [(1, text, "r"), (2, "one two three four five six seven eight nine ten", "r"), (3, None, "r"), (4, "clean", "r")],
        "doc_id int, text string, row string",
    )
    cut = {r.doc_id: r for r in remove_contamination(docs, items).collect()}
    assert sorted(cut) == [1, 3, 4]
    assert cut[1].text == "Before it. ! After it comes more text, and more and more of it."
    assert cut[3].text is None and cut[4].row == "r"
    assert [r.doc_id for r in drop_contaminated(docs, items).orderBy("doc_id").collect()] == [3, 4]
    assert drop_contaminated(docs, items).columns == docs.columns


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id int, text string")
    assert contamination(empty(spark), items).collect() == []
    docs = awkward(spark)
    assert got(contamination(docs, items)) == brute(plain(docs, "doc_id"), [])
    assert drop_contaminated(docs, items).count() == docs.count()


def test_automaton_without_items():
    assert ItemAutomaton([], 10).least == 10


def test_mirrored_words_are_told_apart(spark):
    one, other = mirrored()
    docs = spark.createDataFrame([(1, f"a {other} b"), (2, f"a {one} b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, f"a {one} b")], "item_id bigint, text string")
    assert [r.contaminated for r in contamination(docs, items).orderBy("doc_id").collect()] == [False, True]
