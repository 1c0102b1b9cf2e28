"""Every score of the classifiers against a plain scorer, word by word in Python."""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from patronage.llm import language_id, quality, toxicity
from patronage.llm.columns import id_remainder
from patronage.llm.sampling import joined_sample
from patronage.llm.text import blocks, mix, segment_hashes
from tests.llm.helpers import awkward, remainder, words


def tables(spark, small, name):
    """The small tables, and the awkward rows with labels of their own."""
    if name == "small":
        return spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    labels = [(i, i % 2, (i + 1) % 2) for i in range(1, 13)]
    return awkward(spark), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def same(found, want):
    """Scores by (id, held out), repeated rows included."""
    assert sorted(found) == sorted(want)
    for key in want:
        assert sorted(found[key]) == pytest.approx(sorted(want[key]), abs=1e-9)


def gathered(rows):
    out = defaultdict(list)
    for doc, held, score in rows:
        out[str(doc), held].append(score)
    return out


@pytest.mark.parametrize("name", ["small", "awkward"])
def test_languages(spark, small, name):
    docs, _ = tables(spark, small, name)
    model = language_id.train(docs.where(id_remainder("doc_id", 3) != 1))
    grams: dict[str, np.ndarray] = {}
    want, languages = [], defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        own, total, lettered = words(r.text), model.log_prior.astype(float), False
        for w in own:
            if w not in grams:
                grams[w] = model.log_probability[language_id.ngram_buckets([w])[0]].astype(float).sum(axis=0)
            total = total + grams[w]
            lettered = lettered or any(map(str.isalpha, w))
        score, lang = 0.0, "und"
        if lettered:
            lang = model.languages[int(total.argmax())]
            score = 1 / sum(math.exp(t - total.max()) for t in total)
        want.append((r.doc_id, remainder(r.doc_id, 3) == 1, score))
        languages[str(r.doc_id)].append(lang)
    rows = language_id.identify_language(docs).collect()
    same(gathered((r.doc_id, r.held_out, r.score) for r in rows), gathered(want))
    found = defaultdict(list)
    for r in rows:
        found[str(r.doc_id)].append(r.lang_pred)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in languages.items()}


@pytest.mark.parametrize("name", ["small", "awkward"])
def test_toxicity(spark, small, name):
    docs, labels = tables(spark, small, name)
    sample = joined_sample(docs, labels.where(id_remainder("doc_id", 5) != 0), "toxic", "text", "doc_id", toxicity.SAMPLE_ROWS)
    model = toxicity.fit(sample["text"], sample["label"])
    seen: dict[str, float] = {}
    want = []
    for r in docs.select("doc_id", "text").collect():
        scores = []
        for w in words(r.text):
            if w not in seen:
                seen[w] = sum(model.bucket_scores[b] for b in toxicity.subwords(w)) / len(toxicity.subwords(w))
            scores.append(seen[w])
        size = min(toxicity.WINDOW, len(scores))
        best = max((sum(scores[i : i + size]) / size for i in range(len(scores) - size + 1)), default=0.0) if size else 0.0
        score = 1 / (1 + math.exp(-(model.slope * best + model.shift)))
        want.append((r.doc_id, remainder(r.doc_id, 5) == 0, score))
    rows = toxicity.score_toxicity(docs, labels).collect()
    same(gathered((r.doc_id, r.held_out, r.score) for r in rows), gathered(want))


def tokens(text):
    """The pieces of a text as bytes, cut where the operator says."""
    for _, block in blocks(pa.array([text or ""], pa.string())):
        starts = np.flatnonzero(quality.cut_points(block)).tolist()
        return [block.data[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(block.data)])]
    return []


def number(value, kind):
    mixed = mix(np.array([value], np.uint64) + quality._SPREAD[kind])
    return int(mixed[0] >> np.uint64(64 - quality.BITS))


def features(text):
    """Distinct feature numbers: tokens, pairs, forms, pairs and triples of forms."""
    parts = tokens(text)
    name = [int(segment_hashes(np.frombuffer(p, np.uint8), np.array([0]), np.array([len(p)]))[0]) for p in parts]
    form = [quality.shape(p.decode("utf-8", "replace")) for p in parts]
    after = lambda a, b: (int(mix(np.array([a], np.uint64))[0]) + b) % (1 << 64)
    found = {number(n, 0) for n in name} | {number(f, 2) for f in form}
    found |= {number(after(a, b), 1) for a, b in zip(name, name[1:])}
    found |= {number(after(a, b), 3) for a, b in zip(form, form[1:])}
    found |= {number(after(after(a, b), c), 4) for a, b, c in zip(form, form[1:], form[2:])}
    return found


@pytest.mark.parametrize("name", ["small", "awkward"])
def test_quality(spark, small, name):
    docs, labels = tables(spark, small, name)
    sample = joined_sample(docs, labels.where(id_remainder("doc_id", 3) != 1), "quality", "text", "doc_id", quality.SAMPLE_ROWS)
    model = quality.fit(sample["text"], sample["label"])
    rows = {}
    for r in quality.score_quality(docs, labels).collect():
        rows.setdefault(str(r.doc_id), []).append(r.score)
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for doc, text in [t for t in texts if len(t[1] or "") < 3000][:60]:
        own = features(text)
        size = math.sqrt(sum(model.ratio[f] ** 2 for f in own)) or 1.0
        margin = sum(model.ratio[f] * model.weight[f] for f in own) / size + model.bias
        score = 1 / (1 + math.exp(-(model.slope * margin + model.shift)))
        assert any(s == pytest.approx(score, abs=1e-9) for s in rows[str(doc)])
