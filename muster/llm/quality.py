"""Quality rules as a bitmask ledger. DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule; a policy is
a versioned mask of the rules that reject. Applying a policy, comparing versions and ablations are then bit
operations on narrow rows: no text is read again.

All counts are made inside the row. Repeated 8-word windows are found by hashing each window, and only in texts whose
windows are not all distinct are they sorted to find which words they cover. So nothing is shuffled, and a text's
cost is its length times a logarithm.

Defined cases: a NULL text has no words; every document, blank ones included, has a ledger row; rows that repeat are
judged alike. Extra columns are ignored by the ledger and passed through by ``passing``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import SPACE, unpacked

WINDOW = 8

#: Rules in the order of their bits: name and the condition under which a document fails. The first two are the base.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines"),
    ("shouting", "10 * n_shouted > 3 * n_words"),
    ("exclamation", "10 * n_marks > 3 * n_words"),
    ("word_length", "word_chars > 20 * n_words OR word_chars < 2 * n_words"),
)
BASE = ("few_words", "repeated_words")


def bit(name: str) -> int:
    return 1 << [n for n, _ in RULES].index(name)


@dataclass(frozen=True)
class Policy:
    """The rules that reject a document, under a version."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(n) for n in self.rules)


POLICIES = (
    Policy("base", BASE),
    Policy("v1", (*BASE, "symbols", "repeated_lines", "word_length")),
    Policy("v2", tuple(n for n, _ in RULES)),
)
CURRENT = POLICIES[-1]


def _covered(places: str) -> Column:
    """Words covered by the windows that start at the sorted ``places``."""
    gaps = f"transform({places}, (p, j) -> if(j + 1 < size({places}), least({WINDOW}, {places}[j + 1] - p), {WINDOW}))"
    return F.expr(f"aggregate({gaps}, 0L, (a, g) -> a + g)")


def ledger(docs: DataFrame, text: str = "text", carry: str = "doc_id") -> DataFrame:
    """``carry`` (one column), the measurements (long) and ``failed``, one bit per rule."""
    rows = docs.select(carry, F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({
        "words": F.filter(F.split("text", SPACE + "+"), lambda w: w != ""),
        "lines": F.filter(F.split("text", "\n"), lambda s: F.rlike(s, F.lit(r"[^\x20\x09-\x0D]"))),
        "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_shouted": F.regexp_count("text", F.lit(r"\p{Lu}{2,}")).cast("long"),
        "n_marks": F.regexp_count("text", F.lit("!+")).cast("long"),
    }).drop("text")
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "windows": F.expr(f"CASE WHEN size(words) > {WINDOW} THEN transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW}))) END"),
    }).drop("words", "lines")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("by_hash", F.when(F.col("windows").isNotNull() & repeats, pairs)).drop("windows")
    twice = "filter(by_hash, (x, j) -> (j > 0 AND by_hash[j - 1].h = x.h) OR (j + 1 < size(by_hash) AND by_hash[j + 1].h = x.h))"
    rows = rows.withColumn("places", F.expr(f"array_sort(transform({twice}, x -> x.i))")).drop("by_hash")
    # Always 0. As it is not deterministic by Spark's book, filters on this count stay above it; pushed below they would
    # hold the sorts in their lambdas and run them for every window.
    nothing = F.shiftrightunsigned(F.monotonically_increasing_id(), 63)
    covered = F.coalesce(F.when(F.col("places").isNotNull(), _covered("places")), F.lit(0)).cast("long")
    rows = rows.withColumn("n_repeat_words", covered + nothing).drop("places")
    failed = sum((F.when(F.expr(rule), F.lit(bit(name))).otherwise(F.lit(0)) for name, rule in RULES), F.lit(0))
    return rows.withColumn("failed", failed.cast("long"))


def rejects(policy: Policy = CURRENT, failed: str | Column = "failed") -> Column:
    column = F.col(failed) if isinstance(failed, str) else failed
    return column.bitwiseAND(F.lit(policy.mask)) != 0


def verdicts(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``."""
    base = rejects(Policy("base", BASE))
    return ledger(docs).withColumn("base_failed", base).withColumn("kept", ~base & ~rejects(policy))


def ablations(book: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each policy and rule of it: documents the rule fails, those that it alone rejects, and the bits that were
    ever set together with it. One aggregate of the ledger; no text is read."""
    sums = []
    for p in policies:
        live = F.col("failed").bitwiseAND(F.lit(p.mask))
        sums += [F.count_if(live != 0).alias(f"{p.version}:all")]
        for name in p.rules:
            has = live.bitwiseAND(F.lit(bit(name))) != 0
            sums += [
                F.count_if(has).alias(f"{p.version}:{name}:fails"),
                F.count_if(live == F.lit(bit(name))).alias(f"{p.version}:{name}:alone"),
                F.coalesce(F.bit_or(F.when(has, live)), F.lit(0)).alias(f"{p.version}:{name}:with"),
            ]
    totals = book.agg(*sums)
    rows = [
        F.struct(
            F.lit(p.version).alias("policy"), F.lit(name).alias("rule"), F.col(f"`{p.version}:all`").alias("rejected"),
            F.col(f"`{p.version}:{name}:fails`").alias("fails"), F.col(f"`{p.version}:{name}:alone`").alias("only_this"),
            F.col(f"`{p.version}:{name}:with`").alias("fails_with"),
        )
        for p in policies for name in p.rules
    ]
    return totals.select(F.inline(F.array(*rows)))


def passing(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with all their columns; nothing is shuffled."""
    rows = docs.select(F.struct(*docs.columns).alias("row")).select("row", F.col("row.text").alias("text"))
    judged = ledger(rows, carry="row")
    return unpacked(judged.where(~rejects(Policy("base", BASE)) & ~rejects(policy)))
