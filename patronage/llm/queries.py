"""One query per operator over the given tables, and the SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers

from patronage.llm.collocations import collocations
from patronage.llm.columns import table
from patronage.llm.decontaminate import contamination
from patronage.llm.exact_dedup import exact_groups
from patronage.llm.language_id import identify_language
from patronage.llm.lexical_search import ranked_search
from patronage.llm.near_dedup import near_groups
from patronage.llm.packing import pack_documents
from patronage.llm.quality import score_quality
from patronage.llm.repeated_passages import repeated_passages
from patronage.llm.suffix_dedup import suffix_digest
from patronage.llm.token_count import token_counts
from patronage.llm.token_files import token_round_trip
from patronage.llm.toxicity import score_toxicity


def op1_token_counts(spark, sf_dir):
    return token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op2_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_near_dedup(spark, sf_dir):
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "class_id", "class_size", "kept")


def op4_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_files(spark, sf_dir):
    return token_round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0
    )


def op7_language_id(spark, sf_dir):
    return identify_language(table(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_repeated_passages(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents")).drop("doc")


def op10_packing(spark, sf_dir):
    return pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1
    )


def op11_suffix_dedup(spark, sf_dir):
    return suffix_digest(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_near_dedup": op3_near_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_token_files": op6_token_files,
    "op7_language_id": op7_language_id,
    "op8_quality": op8_quality,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_packing": op10_packing,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS text,
    REGEXP_REPLACE(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
  FROM documents),
g AS (
  SELECT normal, COUNT(*) AS group_size,
    FIRST(doc_id ORDER BY LENGTH(text) DESC, doc_id) AS keep_id
  FROM d GROUP BY normal)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
  SHA256(d.normal) AS text_sha256
FROM d JOIN g ON d.normal = g.normal""",
    "op12_lexical_search": r"""
WITH word AS (
  SELECT doc_id, UNNEST(REGEXP_EXTRACT_ALL(
    TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM word GROUP BY doc_id, term),
doc AS (SELECT doc_id, CAST(SUM(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS words FROM doc),
wanted AS (
  SELECT DISTINCT item_id, UNNEST(REGEXP_EXTRACT_ALL(
    TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weight AS (
  SELECT term, CAST(FLOOR(1000 * LN((2 * docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id, CAST(SUM(w * ((1000000000 * tf)
    // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // words))))) AS BIGINT) AS score
  FROM wanted JOIN weight USING (term) JOIN tf USING (term) JOIN doc USING (doc_id), total
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(ROW_NUMBER() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50""",
    "op13_collocations": r"""
WITH piece AS (
  SELECT COALESCE(lang, 'und') AS lang, UNNEST(REGEXP_SPLIT_TO_ARRAY(
    TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
seq AS (SELECT lang, REGEXP_EXTRACT_ALL(piece, '[^\x20\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, k, w[i : i + k - 1] AS p, COUNT(*) AS f
  FROM (SELECT lang, w, k, UNNEST(RANGE(1, LEN(w) - k + 2)) AS i
    FROM seq, (SELECT UNNEST(RANGE(1, 6)) AS k) WHERE LEN(w) >= k)
  GROUP BY lang, k, w[i : i + k - 1]),
total AS (SELECT lang, SUM(f) AS n FROM gram WHERE k = 1 GROUP BY lang),
candidate AS (SELECT * FROM gram WHERE k > 1 AND f >= 100),
held AS (
  SELECT DISTINCT lang, f, p FROM (
    SELECT lang, f, p[1 : k - 1] AS p FROM candidate WHERE k > 2
    UNION ALL SELECT lang, f, p[2 : k] AS p FROM candidate WHERE k > 2)),
cut AS (
  SELECT c.lang, c.k, c.p, c.f AS a, x.f AS l, y.f AS r, n, j,
    (1000 * c.f::HUGEINT * n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT c.*, UNNEST(RANGE(1, k)) AS j FROM candidate c ANTI JOIN held USING (lang, f, p)) c
  JOIN total USING (lang)
  JOIN gram x ON x.lang = c.lang AND x.p = c.p[1 : j]
  JOIN gram y ON y.lang = c.lang AND y.p = c.p[j + 1 : c.k]),
best AS (
  SELECT * FROM cut QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
ranked AS (
  SELECT lang, CAST(ROW_NUMBER() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, ARRAY_TO_STRING(p, ' ')) AS INTEGER) AS rank,
    ARRAY_TO_STRING(p, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
  FROM best)
SELECT * FROM ranked WHERE rank <= 2000""",
}
