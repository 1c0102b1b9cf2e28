"""Phrase collocations by best-first branch and bound.

A phrase of words w1..wk with count a is scored by its worst cut into two parts with
counts l and r: 1000 a n / (l r). As a <= r, no phrase that begins with w1 scores above
1000 n / f(w1): prefix counts bound the scores of all that grows from them. The frontier
holds unexpanded first words by that bound, and grown phrases by the better bound of
their last cut and their last word. The best are expanded first (counts of growing
prefixes, in scans of the texts), then the best phrases are settled (exact counts of all
their parts, in one scan for thousands of phrases). A language is done when its
``keep``-th surviving score exceeds every bound that is left; equal bounds are settled.

A phrase does not survive if all its occurrences go on with the same word, or all have
the same word before them: then a longer phrase has the same count. Words are compared by
64-bit hashes there; all counts are of the words themselves.

Python on the driver holds frontier bins, ``keep`` results and one batch of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm import phrases as P
from patronage.session import stage

LEAST = 100  # occurrences of a candidate
LONGEST = 5
KEEP = 2000
FIRST_SHARE = 0.08  # of a language's words that the first round expands; later rounds twice the last
MOST_WORDS = 1_000_000  # words whose hashes are sent to the tasks at once
SETTLE = 4_000  # phrases per language that are settled together
UNKNOWN = "und"


@dataclass
class _Language:
    n: int
    keep: int
    waiting: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # (least f, words, occurrences, bin, part)
    settled: list[tuple] = field(default_factory=list)

    def threshold(self) -> int:
        """The score of the last place, -1 while places are free."""
        return self.settled[self.keep - 1][0] if len(self.settled) >= self.keep else -1

    def bound(self) -> int:
        return 1000 * self.n // self.waiting[0][0] if self.waiting else -2

    def take(self, share: float, most_words: int) -> list[tuple[int, int]]:
        """The best bins that may still hold a result, up to a share of all occurrences."""
        taken, left = [], share * self.n
        while self.waiting and self.bound() >= self.threshold() and (left > 0 and most_words > 0 or not taken):
            _, words, occurrences, code, part = self.waiting.pop(0)
            taken.append((code, part))
            left -= occurrences
            most_words -= words
        return taken

    def add(self, found: list[tuple]) -> None:
        self.settled += found
        self.settled.sort(key=lambda s: (-s[0], -s[1], s[2].encode("utf-8")))
        del self.settled[self.keep :]


def best_cut(a: int, n: int, parts: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(score, l, r) of the lowest-scoring cut; the first of equal ones."""
    return min(((1000 * a * n // (left * right), left, right) for left, right in parts), key=lambda c: c[0])


def _bin(f) -> F.Column:
    return F.floor(F.log2(f) * 4).cast("int")


def _part(parts: int) -> F.Column:
    return F.pmod(F.col("h"), F.lit(parts)).cast("int")


def _hashes(frame: DataFrame) -> np.ndarray:
    column = frame.select("h").toArrow()["h"]
    return np.unique(column.to_numpy().astype(np.int64).view(np.uint64))


class Miner:
    def __init__(self, rows: DataFrame, least: int, longest: int, keep: int, settle: int, most_words: int):
        self.rows, self.spark = rows, rows.sparkSession
        self.least, self.longest, self.settle, self.most_words = least, longest, settle, most_words
        counts = rows.mapInArrow(P.word_counts, P.WORD_COUNTS)
        every = counts.groupBy("lang", "word").agg(F.sum("n").alias("f"), F.min("h").alias("h"))
        every = stage(every, "words")
        # One row per language.
        totals = every.groupBy("lang").agg(F.sum("f").alias("n")).collect()
        self.languages = {r["lang"]: _Language(r["n"], keep) for r in totals}
        self.totals = self.spark.createDataFrame([(r["lang"], r["n"]) for r in totals], "lang string, n bigint")
        self.words = every.where(F.col("f") >= least).withColumn("bin", _bin(F.col("f")))
        bins = (
            self.words.groupBy("lang", "bin")
            .agg(F.count("*").alias("words"), F.sum("f").alias("occurrences"), F.min("f").alias("f"))
            .collect()
        )
        frequent = sum(b["words"] for b in bins)
        # The frequent words are a filter only; without it the counts are the same.
        self.known = _hashes(self.words) if frequent <= most_words else None
        self.parts = {}
        for b in sorted(bins, key=lambda b: b["f"]):
            parts = -(-b["words"] // most_words)
            self.parts[b["bin"]] = max(parts, self.parts.get(b["bin"], 1))
        for b in sorted(bins, key=lambda b: b["f"]):
            parts = self.parts[b["bin"]]
            for part in range(parts):
                sizes = (-(-b[c] // parts) for c in ("words", "occurrences"))
                self.languages[b["lang"]].waiting.append((b["f"], *sizes, b["bin"], part))

    def expand(self, taken: list[tuple[str, int, int]]) -> DataFrame:
        """All phrases that begin with words of the taken bins: lang, phrase, size, a, and
        ``bound`` of those that survive (null: others)."""
        chosen = self.spark.createDataFrame(taken, "lang string, bin int, part int")
        parts = self.spark.createDataFrame(list(self.parts.items()), "bin int, parts int")
        first = (
            self.words.join(F.broadcast(parts), "bin")
            .withColumn("part", F.pmod(F.col("h"), F.col("parts").cast("bigint")).cast("int"))
            .join(F.broadcast(chosen), ["lang", "bin", "part"])
        )
        pairs = stage(self._extended(_hashes(first), 1, 2), "pairs")
        grown, count = pairs, pairs.count()
        parts = -(-count // self.most_words)
        for part in range(parts if self.longest > 2 else 0):
            longer = self._extended(_hashes(pairs.where(_part(parts) == part)), 2, self.longest)
            grown = grown.unionByName(stage(longer, "phrases"))
        return stage(self._bounded(grown), "candidates")

    def _extended(self, wanted: np.ndarray, size: int, longest: int) -> DataFrame:
        sent = self.spark.sparkContext.broadcast((wanted, self.known))
        found = self.rows.mapInArrow(P.extensions(sent, size, longest), P.EXTENSIONS)
        counted = found.groupBy("lang", "phrase", "size").agg(
            F.sum("n").alias("a"),
            F.min("h").alias("h"),
            F.min("next_low").alias("next_low"),
            F.max("next_high").alias("next_high"),
            F.min("before_low").alias("before_low"),
            F.max("before_high").alias("before_high"),
        )
        same = lambda low, high: (F.col(low) == F.col(high)) & (F.col(low) != 0)
        held = same("next_low", "next_high") | same("before_low", "before_high")
        survives = (F.col("size") == self.longest) | ~held
        return counted.where(F.col("a") >= self.least).select("lang", "phrase", "h", "size", "a", survives.alias("survives"))

    def _bounded(self, grown: DataFrame) -> DataFrame:
        words = lambda name: self.words.select("lang", F.col("word").alias(name), F.col("f").alias(f"f_{name}"))
        cut = (
            grown.where("survives")
            .withColumn("first", F.substring_index("phrase", " ", 1))
            .withColumn("last", F.substring_index("phrase", " ", -1))
            .withColumn("head", F.expr("substring_index(phrase, ' ', size - 1)"))
            .join(words("first"), ["lang", "first"])
            .join(words("last"), ["lang", "last"])
            .join(grown.select("lang", F.col("phrase").alias("head"), F.col("a").alias("f_head")), ["lang", "head"], "left")
            .join(F.broadcast(self.totals), "lang")
        )
        big = lambda *names: " * ".join(f"cast({n} as decimal(19,0))" for n in names)
        bound = F.least(
            F.expr("(1000 * cast(n as decimal(19,0))) div f_first"),
            F.expr(f"(1000 * {big('a', 'n')}) div ({big('coalesce(f_head, f_first)', 'f_last')})"),
        )
        return cut.select("lang", "phrase", "size", "a", bound.alias("bound"))

    def best(self, candidates: DataFrame, place: dict[str, tuple[int, str]]) -> list[tuple]:
        """Per language the next phrases by falling bound that may still be results."""
        rows = [(g, self.languages[g].threshold(), *place[g]) for g in place]
        at = self.spark.createDataFrame(rows, "lang string, threshold bigint, b bigint, p string")
        order = Window.partitionBy("lang").orderBy(F.desc("bound"), "phrase")
        return (
            candidates.join(F.broadcast(at), "lang")
            .where("bound >= threshold and (bound < b or (bound = b and phrase > p))")
            .withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= self.settle)
            .select("lang", "phrase", "a", "bound")
            .orderBy("lang", "place")
            .collect()
        )

    def counts(self, pairs: set[tuple[str, str]]) -> dict[tuple[str, str], int]:
        """Exact counts of some sequences of 1 to 4 words."""
        single = sorted(p for p in pairs if " " not in p[1])
        longer = sorted(p for p in pairs if " " in p[1])
        wanted = self.spark.createDataFrame(single, "lang string, word string")
        found = {(r["lang"], r["word"]): r["f"] for r in self.words.join(F.broadcast(wanted), ["lang", "word"]).collect()}
        if longer:
            prefixes = {(g, " ".join(w[:i])) for g, p in longer for w in [p.split(" ")] for i in range(1, len(w))}
            sent = self.spark.sparkContext.broadcast(
                (np.unique(P.sequence_hashes(longer)), np.unique(P.sequence_hashes(sorted(prefixes))))
            )
            counted = self.rows.mapInArrow(P.sequence_counts(sent, self.longest - 1), P.SEQUENCE_COUNTS)
            summed = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
            chosen = self.spark.createDataFrame(longer, "lang string, phrase string")
            found |= {
                (r["lang"], r["phrase"]): r["n"]
                for r in summed.join(F.broadcast(chosen), ["lang", "phrase"]).collect()
            }
        return found

    def settle_best(self, candidates: DataFrame) -> None:
        top = (1 << 63) - 1
        place = {g: (top, "") for g in self.languages}
        while chosen := self.best(candidates, place):
            cuts = {}
            for r in chosen:
                w = r["phrase"].split(" ")
                cuts[r["lang"], r["phrase"]] = [(" ".join(w[:k]), " ".join(w[k:])) for k in range(1, len(w))]
            counts = self.counts({(g, part) for (g, _), own in cuts.items() for cut in own for part in cut})
            found: dict[str, list] = {}
            for r in chosen:
                g, n = r["lang"], self.languages[r["lang"]].n
                parts = [(counts[g, x], counts[g, y]) for x, y in cuts[g, r["phrase"]]]
                score, left, right = best_cut(r["a"], n, parts)
                found.setdefault(g, []).append((score, r["a"], r["phrase"], left, right))
                place[g] = (r["bound"], r["phrase"])
            for g, own in found.items():
                self.languages[g].add(own)

    def run(self, share: float) -> list[tuple]:
        while True:
            each = self.most_words // max(1, len(self.languages))
            taken = [(g, *t) for g, own in self.languages.items() for t in own.take(share, each)]
            if not taken:
                break
            self.settle_best(self.expand(taken))
            share *= 2
        return [
            (g, rank, phrase, a, left, right, own.n, score)
            for g, own in self.languages.items()
            for rank, (score, a, phrase, left, right) in enumerate(own.settled, 1)
        ]


RESULT = "lang string, rank int, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    keep: int = KEEP,
    lang: str = "lang",
    text: str = "text",
    first_share: float = FIRST_SHARE,
    settle: int = SETTLE,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """The ``keep`` best phrases of 2 to ``longest`` words of each language: lang, rank,
    phrase, a, l, r, n, score.

    Null text counts as empty, null language as ``und``; repeated rows count each. Equal
    scores go by falling count, then by the bytes of the phrase. ``first_share``,
    ``settle`` and ``most_words`` bound what is worked on at once and change no result.
    Languages are few: one row of each reaches the driver. Other columns are not read.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    miner = Miner(rows, least, longest, keep, settle, most_words)
    return docs.sparkSession.createDataFrame(miner.run(first_share), RESULT)
