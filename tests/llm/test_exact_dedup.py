from __future__ import annotations

import hashlib
import re

from patronage.llm.exact_dedup import exact_dedup, exact_groups
from tests.llm.helpers import awkward, empty


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    groups: dict[str, list] = {}
    for doc, text in rows:
        groups.setdefault(normal(text), []).append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for text, members in groups.items():
        keep = min(members)[3]
        kept = False
        for m in sorted(members):
            mine = not kept and m == min(members)
            kept = kept or mine
            out.append((str(m[3]), str(keep), len(members), mine, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert got(exact_groups(docs)) == brute(rows)


def test_longer_original_stays(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "a\tb "), (4, "ab")], "doc_id int, text string")
    assert {r.keep_id for r in exact_groups(docs).collect()} == {2}
    assert [r.doc_id for r in exact_dedup(docs).collect()] == [2]


def test_dedup_keeps_one_row_of_each_group(spark):
    docs = awkward(spark)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    want = sorted(x[0] for x in brute(rows) if x[3])
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_no_python_in_the_plan(spark):
    for df in (exact_groups(awkward(spark)), exact_dedup(awkward(spark))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert exact_groups(empty(spark)).collect() == []
    assert exact_dedup(empty(spark)).collect() == []
