"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding disguises.

Folding: lower case, accents off, letters of other scripts that look Latin and full-width forms made Latin, digits
and symbols that stand for letters inside a word read as those letters, everything else a blank.

The lexicon is learned from labelled rows: words and word beginnings that are found in toxic documents far more
often, word for word, than in others, each weighing its log-odds. Of a chain of beginnings the one with the most
evidence is taken. A word pair around a term that is found mostly in clean documents is an exception and its hit does not count.
The weight per hundred words, on a log scale, goes through a logistic curve fitted on the same rows.

The fit reads at most ``train_rows`` labelled rows (those with the lowest hash of doc_id) and keeps at most
``max_terms`` terms, both parameters; scoring reads every text whole and has no shuffle.

Defined cases: a NULL or empty text has no words and the score of no hits. Labels that are NULL, or whose doc_id is
not among the documents, teach nothing; of labels that repeat a doc_id each counts. Without any labelled toxic row
the lexicon is empty and all scores are 0. Rows that repeat are scored alike. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 20_000
MAX_TERMS = 5_000
MAX_EXCEPTIONS = 5_000
#: A term must beat chance by this log-likelihood and weigh at least this much.
EVIDENCE, MIN_WEIGHT = 15.0, 1.5
#: It must be found in so many toxic rows and in this share of them; a row counts a term at most so often.
SUPPORT, SUPPORT_SHARE, REPEATS = 4, 0.01, 8
BEGINNINGS = range(4, 13)
FOLDS = 5
#: Words added to every length, so that one weak hit in a short text is not a high share.
PAD = 20

# Letters that look Latin, and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "з": "e", "и": "u", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "п": "n", "г": "r",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "σ": "o",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ɑ": "a", "ɡ": "g", "ſ": "s",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "+": "t"}

_LOOK = str.maketrans(LOOKALIKES)
_DIGIT_WORD = re.compile(r"(?=[0-9]*[^\W\d_])\w*[0-9]\w*")
_DIGITS = str.maketrans(DIGITS)
_SIGNS = re.compile(r"[@$!|€+]+(?=[^\W\d_])")
_SIGN = str.maketrans(SIGNS)
_MARKS = re.compile("[̀-ͯ​-‏⁠﻿­]+")
_ASCII_BLANK = bytes(c if 97 <= c <= 122 else 32 for c in range(256))
_GAP = re.compile(r"[\W\d_]")


def fold(text: str) -> str:
    """The text with its disguises off: letters, and a blank for anything else, between two blanks."""
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower().translate(_LOOK)
    if any(d in text for d in DIGITS):
        text = _DIGIT_WORD.sub(lambda m: m[0].translate(_DIGITS), text)
    if any(s in text for s in SIGNS):
        text = _SIGNS.sub(lambda m: m[0].translate(_SIGN), text)
    if text.isascii():
        return " " + text.encode().translate(_ASCII_BLANK).decode() + " "
    return " " + _GAP.sub(" ", text) + " "


@dataclass(frozen=True)
class Lexicon:
    """``terms`` are beginnings " begin" or whole words " word " with weights; ``exceptions`` are pairs of words."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset = frozenset()
    slope: float = 0.0
    offset: float = -math.inf

    def score(self, strength: float) -> float:
        z = self.slope * strength + self.offset
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def automaton(terms: dict[str, float]) -> ahocorasick.Automaton | None:
    machine = ahocorasick.Automaton()
    for term, weight in terms.items():
        machine.add_word(term, (len(term), weight))
    if terms:
        machine.make_automaton()
    return machine if terms else None


def _word(text: str, start: int) -> tuple[str, int]:
    """The word that starts at ``start``, and where it ends."""
    end = text.find(" ", start)
    return text[start:end], end


def hits(text: str, machine: ahocorasick.Automaton) -> Iterator[tuple[str, str, str, float]]:
    """(word before, word, word after, weight) of each word that holds a term; the dearest term counts."""
    best: dict[int, float] = {}
    for last, (length, weight) in machine.iter(text):
        start = last - length + 2  # past the leading blank
        best[start] = max(weight, best.get(start, 0.0))
    for start, weight in best.items():
        word, end = _word(text, start)
        before = text[max(0, start - 65) : start].rstrip(" ").rsplit(" ", 1)[-1]
        after = text[end : end + 65].split(" ")
        yield before, word, next((w for w in after if w), ""), weight


def strength(text: str, machine: ahocorasick.Automaton | None, exceptions: frozenset) -> float:
    """Weight of the hits outside exceptions per hundred words, on a log scale."""
    if machine is None:
        return 0.0
    folded = fold(text)
    total = sum(w for a, word, b, w in hits(folded, machine) if (a, word) not in exceptions and (word, b) not in exceptions)
    return math.log1p(100 * total / (len(folded.split()) + PAD)) if total else 0.0


def held_out(doc_id: str | Column = "doc_id", folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of at most ``train_rows`` labelled rows outside the held-out fold; a text teaches once."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    chosen = known.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(train_rows)
    # At most train_rows pairs of numbers: 16 bytes each.
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic").dropDuplicates()


def _terms(folded: str) -> Counter:
    """How often the words and word beginnings of a text occur, at most ``REPEATS`` times each."""
    out: Counter = Counter()
    for word, n in Counter(folded.split()).items():
        if len(word) <= 40:
            out[f" {word} "] += n
            for size in BEGINNINGS:
                if size <= len(word):
                    out[" " + word[:size]] += n
    return Counter({t: min(n, REPEATS) for t, n in out.items()})


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each term the toxic rows that hold it and its occurrences in toxic and clean rows; the empty term counts rows
    and words."""
    for batch in batches:
        rows, counts = Counter(), (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            folded = fold(text)
            mine = _terms(folded)
            mine[""] = len(folded.split())
            counts[toxic != 0].update(mine)
            if toxic:
                rows.update(mine.keys())
        terms = list(counts[0] | counts[1])
        columns = [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (rows, counts[1], counts[0]))]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "rows", "toxic", "clean"])


def _pairs(terms: list[str], counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    columns = [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (counts[1], counts[0]))]
    return pa.RecordBatch.from_arrays(columns, names=["term", "toxic", "clean"])


def _log_odds(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    return math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))


def _strongest(evidence: dict[str, float]) -> Iterator[str]:
    """Terms by falling evidence, the longer of equals first, none of which begins another."""
    kept: set[str] = set()
    begun: set[str] = set()
    for term in sorted(evidence, key=lambda t: (-round(evidence[t], 6), -len(t), t)):
        if term not in begun and not any(term[:n] in kept for n in range(2, len(term))):
            kept.add(term)
            begun.update(term[:n] for n in range(2, len(term) + 1))
            yield term


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Logistic regression of a label on one strength, by Newton steps."""
    features, beta = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -50, 50)))
        slope = features.T @ (p - y) + ridge * beta
        curve = (features * (p * (1 - p))[:, None]).T @ features + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta - step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def _strengths(terms: dict[str, float], exceptions: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(terms)
        for batch in batches:
            found = [strength(t or "", machine, exceptions) for t in batch.column("text").to_pylist()]
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(found, pa.float64())], names=[*kept, "strength"])

    return run


def _pairs_around(terms: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(terms)
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                pairs = set()
                for a, word, b, _ in hits(fold(text), machine):
                    pairs.update((f"{a} {word}", f"{word} {b}"))
                counts[toxic != 0].update(pairs)
            yield _pairs(list(counts[0] | counts[1]), counts)

    return run


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, max_terms: int = MAX_TERMS) -> Lexicon:
    """Learn terms, exceptions and curve; all that comes to the driver is bounded by the parameters."""
    rows = training_rows(docs, labels, train_rows)
    kind = "term string, toxic long, clean long"
    counted = rows.mapInArrow(_count_terms, "term string, rows long, toxic long, clean long").groupBy("term").agg(
        *(F.sum(c).alias(c) for c in ("rows", "toxic", "clean"))
    )
    wanted = counted.where((F.col("term") == "") | ((F.col("rows") >= SUPPORT) & (F.col("toxic") > F.col("clean") / 50)))
    wanted = wanted.orderBy(F.length("term") > 0, F.col("rows").desc(), "term").limit(20 * max_terms)
    got = wanted.collect()
    found, rows_with = {r["term"]: (r["toxic"], r["clean"]) for r in got}, {r["term"]: r["rows"] for r in got}
    toxic_rows = rows_with.get("", 0)
    all_toxic, all_clean = found.pop("", (0, 0))
    if not all_toxic or not all_clean:
        return Lexicon()
    share = all_toxic / (all_toxic + all_clean)

    def weight(toxic: int, clean: int) -> float:
        return _log_odds(toxic, clean, all_toxic, all_clean)

    def evidence(toxic: int, clean: int) -> float:
        n = toxic + clean
        return toxic * math.log(toxic / (n * share)) + (clean * math.log(clean / (n * (1 - share))) if clean else 0.0)

    strong = {
        t: evidence(*c)
        for t, c in found.items()
        if rows_with[t] >= SUPPORT_SHARE * toxic_rows and weight(*c) >= MIN_WEIGHT and evidence(*c) >= EVIDENCE
    }
    terms = {t: weight(*found[t]) for t in islice(_strongest(strong), max_terms)}
    if not terms:
        return Lexicon()
    around = rows.mapInArrow(_pairs_around(terms), kind).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    mostly_clean = around.where((F.col("clean") >= 8) & (F.col("clean") > 20 * F.col("toxic"))).orderBy(F.col("clean").desc(), "term")
    exceptions = frozenset(tuple(r["term"].split(" ")) for r in mostly_clean.limit(MAX_EXCEPTIONS).collect())
    points = rows.mapInArrow(_strengths(terms, exceptions), "toxic int, strength double").limit(train_rows).toPandas()
    slope, offset = _fit_curve(points["strength"].to_numpy(), (points["toxic"] != 0).to_numpy().astype(float))
    return Lexicon(terms, exceptions, slope, offset)


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; the texts are the only input of a score."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    strengths = rows.mapInArrow(_strengths(lexicon.terms, lexicon.exceptions), f"doc_id {kind}, held_out boolean, strength double")
    if not lexicon.terms:
        return strengths.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    score = 1 / (1 + F.exp(-(F.col("strength") * lexicon.slope + lexicon.offset)))
    return strengths.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
