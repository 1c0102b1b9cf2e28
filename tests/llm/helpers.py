"""Small tables with the awkward cases that every operator must define."""

from __future__ import annotations

import re
from zlib import crc32

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, found string, place int"

BASE = "The quick brown fox jumps over the lazy dog near the river bank while seven old men watch it go by"
AWKWARD = [
    (1, BASE, "en"),
    (2, BASE, "en"),  # a copy
    (2, BASE, "en"),  # a repeated row
    (3, None, "en"),
    (4, "", None),
    (None, "A text of nobody, with its own words: été, größer, niño.", "fr"),
    (5, " \t\n ", "de"),
    (6, "12345 !!! 777", "de"),
    (7, "x" * 3000 + " " + "long words and " * 4000, "en"),
    (8, "日本語のテキストには空白がない。" * 20, "ja"),
    (9, "don't stop<|endoftext|>now  two spaces\n\nlines nbsp ▁▁ x's 3.14", "en"),
    (10, BASE.replace("fox", "cat"), "en"),
    (11, "éa combining\r\nmark ŉ İ ß   sep \x85 nel \x1c fs", None),
    (12, " leading and trailing ", "en"),
]


def awkward(spark):
    rows = [(i, t, g, None, None if t is None else len(t), "r", "f", 7) for i, t, g in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def remainder(doc_id, modulus):
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def mirrored(letters="in", size=2048):
    """Two unequal words whose hashes are equal under any polynomial of 64 bits."""
    order = [bin(i).count("1") % 2 for i in range(size)]
    return "".join(letters[i] for i in order), "".join(letters[1 - i] for i in order)
