from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from patronage.llm.repeated_passages import remove_repeats, repeated_passages
from tests.llm.helpers import awkward, empty, words

CUT = {"line": r"(?<=\n)", "sentence": r"(?<=[.!?])(?=[ \t-\r])|(?<=\n)|(?<=[.!?])$"}


def slices(text, kind):
    """(first word, words) of every line or sentence that has words."""
    out, at = [], 0
    for part in re.split(CUT[kind], text or ""):
        own = words(part)
        if own:
            out.append((at, own))
        at += len(own)
    return out


def bag(w):
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def brute(docs, min_words=25):
    """{(doc, line?, first word): class} of the repeated units, by inverted lists."""
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    units = []
    for doc, text in docs:
        units += [(doc, True, f, tuple(w)) for f, w in slices(text, "line") if len(w) >= min_words]
        units += [(doc, False, f, tuple(w)) for f, w in slices(text, "sentence") if len(w) >= 5]
    lines = {u[3]: bag(u[3]) for u in units if u[1]}
    holders, shared = defaultdict(list), Counter()
    for name, own in lines.items():
        for s in own:
            holders[s].append(name)
    for names in holders.values():
        shared.update((a, b) for i, a in enumerate(names) for b in names[i + 1 :])
    for (a, b), n in shared.items():
        if n >= 0.8 * (len(lines[a]) + len(lines[b]) - n):
            top[find((True, a))] = find((True, b))
    def in_several_documents(units):
        where = defaultdict(set)
        for u in units:
            where[find((u[1], u[3]))].add(u[0])
        return [u for u in units if len(where[find((u[1], u[3]))]) > 1]

    units = in_several_documents(units)
    kept = [u for u in units if u[1]]
    by_doc = defaultdict(list)
    for u in units:
        if not u[1]:
            by_doc[u[0]].append(u)
    # A run goes on where another document has the same two sentences as near.
    pairs = defaultdict(set)
    near = lambda u, v: v[2] - u[2] - len(u[3]) <= 10
    for doc, own in by_doc.items():
        own.sort(key=lambda u: u[2])
        for u, v in zip(own, own[1:]):
            if near(u, v):
                pairs[u[3], v[3]].add(doc)
    for own in by_doc.values():
        run = []
        for u in [*own, None]:
            if run and (u is None or not near(run[-1], u) or len(pairs[run[-1][3], u[3]]) < 2):
                kept += run if sum(len(x[3]) for x in run) >= min_words else []
                run = []
            run.append(u)
    units = in_several_documents(kept)
    return Counter((u[0], u[1], len(u[3])) for u in units), units


def got(rows):
    return Counter((r.doc_id, r.line, r.n_words) for r in rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = repeated_passages(docs).collect()
    want, units = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(rows) == want
    found = {r.doc_id for r in rows}
    assert found and found == {u[0] for u in units}
    for r in rows:
        assert r.kept == (r.doc_id == r.keep_id)


def prose(pick, n):
    out = []
    while sum(map(len, out)) < n:
        out.append([f"w{pick.randrange(10**9)}" for _ in range(pick.randint(6, 14))])
    return " ".join(" ".join(s).capitalize() + "." for s in out)


def test_planted_passages(spark):
    pick = random.Random(8)
    passage = prose(pick, 55)
    rows = [(i, prose(pick, 80)) for i in range(20)]
    rows += [(100 + i, f"{prose(pick, 40)} {passage}") for i in range(30)]  # at the end
    rows += [(200, f"{prose(pick, 30)} {passage} {prose(pick, 30)}\n{prose(pick, 30)}")]
    rows += [(201, f"word upon word {passage} and on it goes.\nNew line.")]  # in a sentence
    rows += [(202, f"Heading\n{passage}\nEnd")]
    near = passage.split()
    near[30] = "changed"
    rows += [(203, f"Heading\n{' '.join(near)}\nEnd"), (204, None), (205, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found = repeated_passages(docs).collect()
    assert {r.doc_id for r in found} == {*range(100, 130), 200, 201, 202, 203}
    paragraphs = {r.doc_id: r.class_id for r in found if r.line}
    assert paragraphs[202] == paragraphs[203]
    cleaned = {r.doc_id: r.text for r in remove_repeats(docs).collect()}
    assert len(cleaned) == len(rows) and cleaned[204] is None
    assert all(cleaned[i] == t for i, t in rows if i <= 100)
    assert passage[-40:] not in cleaned[150 - 30] and cleaned[202] == "Heading\n\nEnd"
    assert cleaned[201].startswith("word upon word")


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = repeated_passages(docs, min_words=15).collect()
    # A copy, a repeated row of it and a text with one other word, as paragraphs.
    assert {r.doc_id for r in rows if r.line} >= {1, 2}
    assert {r.doc_id for r in rows} <= {1, 2, 10}
    cut = remove_repeats(docs, min_words=15)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert repeated_passages(empty(spark)).collect() == []
    assert remove_repeats(empty(spark)).collect() == []


def test_repeats_inside_one_document_do_not_count(spark):
    pick = random.Random(9)
    line = prose(pick, 40)
    docs = spark.createDataFrame([(1, f"{line}\n{line}\n{line}"), (2, prose(pick, 60))], "doc_id int, text string")
    assert repeated_passages(docs).collect() == []
    assert sorted(r.text for r in remove_repeats(docs).collect()) == sorted(r.text for r in docs.collect())


def test_large_star_group_matches_all_pairs(spark):
    """2,000 edited forms of one line: few are near the line, more are near each other."""
    pick = random.Random(11)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(2000):
        own = list(base)
        for k in pick.sample(range(80), 2):
            own[k] = f"x{i}y{k}"
        rows.append((i, " ".join(own)))
    bags = [bag(words(t)) for _, t in rows]
    column = {s: k for k, s in enumerate(sorted({s for b in bags for s in b}))}
    held = Counter(s for b in bags for s in b)
    column = {s: k for k, s in enumerate(s for s in column if held[s] > 1)}
    x = np.zeros((len(rows), len(column)), dtype=np.float32)
    for i, b in enumerate(bags):
        x[i, [column[s] for s in b if s in column]] = 1
    shared, sizes = x @ x.T, np.array([len(b) for b in bags])
    near = shared / (sizes[:, None] + sizes[None, :] - shared) >= 0.8
    np.fill_diagonal(near, True)
    top = np.arange(len(rows))
    while True:
        lower = np.where(near, top[None, :], len(rows)).min(axis=1)
        if (lower == top).all():
            break
        top = lower
    sizes = Counter(top.tolist())
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found = repeated_passages(docs).where("line").collect()
    classes = defaultdict(set)
    for r in found:
        classes[r.class_id].add(r.doc_id)
    want = {frozenset(np.flatnonzero(top == k).tolist()) for k, n in sizes.items() if n > 1}
    assert max(map(len, want)) > 300
    missed = set().union(*want) - {r.doc_id for r in found}
    # Only pairs that share no bucket can be missed: once in 1,300 at the limit.
    assert len(missed) <= 4 and max(map(len, classes.values())) >= max(map(len, want)) - 4
    assert all(any(own <= w for w in want) for own in classes.values())


def test_unrelated_common_sentences_are_no_passage(spark):
    """Every sentence occurs in several documents, but no two of them together."""
    pick = random.Random(12)
    common = [prose(pick, 8) for _ in range(40)]
    rows = [(i, " ".join(pick.sample(common, 6))) for i in range(30)]
    rows += [(100 + i, f"{prose(pick, 9)} {' '.join(common[:5])}") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found = {r.doc_id for r in repeated_passages(docs).collect()}
    assert {100, 101} <= found and len(found) < 10
