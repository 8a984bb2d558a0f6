"""URL filters: pattern rules indexed by their rarest literal token. DataFrame functions only.

Every rule has a regular expression over host and path and some literal tokens that each url it fits must hold. The
tokens' frequencies are counted over all urls, and a rule is indexed under its rarest one. The tokens of a url fetch
candidate rules by a join, only those run their expression, and the longest rule that fits wins. Rules are a list or a
table of any size (``host_rules`` makes one of hosts and paths); a rule without any literal token runs on every url.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, fits no rule with a token and gets the
default verdict. Rows that repeat page_id and url get the same answer. Rules that tie in length are decided by their
text, then block goes before allow. In a table of rules a NULL path is ``/``; rows without a host or an action are no
rules, repeated rows are one. An empty list or table leaves the default verdict. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules of the query, as (action, host, path).
HOST_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Words of the patterns that decide where no rule fits: advertising and tracking, and offers of bets, loans and pills.
MARKS = ("ad", "ads", "adserver", "banner", "banners", "popunder", "popup", "track", "tracker", "tracking")
SERVED = ("ad", "ads", "banner", "popup", "track", "tracker", "tracking")
PARTS = ("click", "count", "engine", "frame", "iframe", "image", "pixel", "script", "serve", "server", "view", "zone")
LURES = ("best", "big", "cheap", "easy", "free", "instant", "online", "win")
GOODS = ("bets", "betting", "casino", "jackpot", "loans", "lottery", "pills", "poker", "slots", "viagra")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``tokens`` are maximal runs of a-z, 0-9 that every fitting host and path holds; ``rank`` 0 goes before 1."""

    rule: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int = 0


def host_rule(action: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``."""
    whole = path[: path.rfind("/") + 1]  # what follows the last slash may go on in the url
    tokens = re.findall("[a-z0-9]+", host + whole)
    return Rule(host + path, action, rf"^(?:[^/]*\.)?{re.escape(host)}(?![^/]){re.escape(path)}", tuple(tokens))


def mark_rule(*words: str, between: str = "") -> Rule:
    """Fits where the words stand in a row, with one of the characters ``between`` them or none if there are no such,
    and nothing from a-z, 0-9 beside them."""
    joint = f"[{between}]" if between else ""
    pattern = f"(?:^|[^a-z0-9]){joint.join(map(re.escape, words))}(?:[^a-z0-9]|$)"
    return Rule(joint.join(words), "block", pattern, words if between else ("".join(words),), 1)


def mark_rules() -> list[Rule]:
    """Every word, every served part, and every lure with its good in both orders, joined or with - or _ between."""
    pairs = [*product(LURES, GOODS), *product(GOODS, LURES)]
    joined = [mark_rule(*pair) for pair in [*product(SERVED, PARTS), *pairs]]
    rules = [*map(mark_rule, MARKS), *joined, *(mark_rule(*pair, between="_-") for pair in pairs)]
    return list(dict.fromkeys(rules))


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + mark_rules()


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.rule, r.action, r.pattern, list(r.tokens), r.rank) for r in rules]
    return spark.createDataFrame(rows, "rule string, action string, pattern string, tokens array<string>, rank int")


def host_rules(table: DataFrame) -> DataFrame:
    """What ``host_rule`` makes, of a table of action, host and path."""
    host, path = F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit("/"))
    # What follows the last slash may go on in the url, so it is no token.
    literal = F.concat(host, F.regexp_extract(path, "(?s)^(.*/)", 1))
    special = r"([^A-Za-z0-9_/\x{80}-\x{10FFFF}])"
    host_pattern, path_pattern = (F.regexp_replace(c, special, r"\\$1") for c in (host, path))
    return table.where("host IS NOT NULL AND action IS NOT NULL").select(
        F.concat(host, path).alias("rule"),
        "action",
        F.concat(F.lit(r"^(?:[^/]*\.)?"), host_pattern, F.lit("(?![^/])"), path_pattern).alias("pattern"),
        F.regexp_extract_all(literal, F.lit("[a-z0-9]+"), F.lit(0)).alias("tokens"),
        F.lit(0).alias("rank"),
    ).distinct()


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path and a key of the row."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id",
        "url",
        F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, parts, 2).alias("path"),
        F.xxhash64("page_id", "url").alias("k1"),
        F.xxhash64(F.lit(1), "url", "page_id").alias("k2"),
    )


def _tokens(urls: DataFrame, whole: bool = False) -> DataFrame:
    """The distinct tokens of each row; ``whole`` adds the empty one, under which lie rules without a token."""
    target = F.concat("host", "path").alias("target")
    runs = F.array_distinct(F.regexp_extract_all(target, F.lit("[a-z0-9]+"), F.lit(0)))
    return urls.select("k1", "k2", target, F.explode(F.array_append(runs, F.lit("")) if whole else runs).alias("token"))


def rarest_token_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under the one of its tokens that the fewest urls hold; under the empty one if it has none."""
    tokens = F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))
    words = rules.select("rule", "action", "pattern", "rank", F.explode(tokens).alias("token"))
    known = words.select("token").distinct()
    # Counted before the join: a token that most urls hold is one row of each task there.
    counts = _tokens(urls).groupBy("token").agg(F.count(F.lit(1)).alias("n")).join(known, "token", "left_semi")
    rare = words.join(counts, "token", "left").groupBy("rule", "action", "pattern", "rank")
    return rare.agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).getField("token").alias("token"))


def candidates(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """k1, k2, target, token and the rule's columns: the rules that each url's tokens fetch."""
    bare = not rules.where(F.size("tokens") == 0).isEmpty()
    return _tokens(urls, bare).join(rarest_token_index(urls, rules), "token")


def url_verdicts(pages: DataFrame, rules: list[Rule] | DataFrame | None = None, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row; a rule of rank 1 gives the verdict but is not named."""
    if not isinstance(rules, DataFrame):
        rules = rule_table(pages.sparkSession, default_rules() if rules is None else rules)
    urls = with_parts(pages)
    fits = candidates(urls, rules).where(F.rlike("target", F.col("pattern")))
    order = F.struct((-F.col("rank")).alias("first"), F.length("rule").alias("n"), "rule", "action")
    best = fits.groupBy("k1", "k2").agg(F.max_by(F.struct("rule", "action", "rank"), order).alias("best"))
    named = F.when(F.col("best.rank") == 0, F.col("best.rule"))
    return urls.join(best, ["k1", "k2"], "left").select(
        "page_id", "host", "path", named.alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )
