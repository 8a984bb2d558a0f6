"""Weekly series and long tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster import labels
from muster.functions import max_na, min_na
from muster.operators.scorecards import ROSTER, service_facts, with_provider_flags

_PCT = ["pct_pharm1st", "pct_pharm1st_100_hour", "pct_contraception"]


def weekly_trend(
    pharm1st: DataFrame,
    contraception: DataFrame,
    bp: DataFrame,
    roster: DataFrame,
    since: date,
    series: Mapping[str, str] = labels.SERIES_LABELS,
) -> DataFrame:
    """Distinct providers per Sunday week and series, long form; undated rows form a NULL week.

    Not cumulative, and weeks without sign-ups are not filled in.
    """
    return trend_from_facts(service_facts(pharm1st, contraception, bp, roster, since, ["week"]), series)


def trend_from_facts(facts: DataFrame, series: Mapping[str, str] = labels.SERIES_LABELS) -> DataFrame:
    """Weekly series from facts with one row per service, provider and week."""
    members = with_provider_flags(facts).where(F.col("service") != ROSTER)
    own = F.when((F.col("service") != labels.BP) | F.col("on_roster"), F.col("service"))
    hundred = F.when((F.col("service") == labels.PHARM1ST) & F.col("is_100_hour"), F.lit("pharm1st_100h"))
    keyed = members.select("week", F.explode(F.array_compact(F.array(own, hundred))).alias("key"))
    counted = keyed.groupBy("week", "key").agg(F.count(F.lit(1)).alias("optin"))
    texts = F.create_map(*[F.lit(x) for kv in series.items() for x in kv])
    return counted.select("week", "optin", F.element_at(texts, F.col("key")).alias("service"))


def trend_range(trend: DataFrame, na_rm: bool = False) -> DataFrame:
    """First week, and last week plus seven days; NULL if a week is missing, unless ``na_rm``."""
    return trend.agg(
        min_na("week", na_rm).alias("range_start"),
        F.date_add(max_na("week", na_rm), 7).alias("range_end"),
    )


def regional_long(regional: DataFrame) -> DataFrame:
    """The three percentages of each region in long form, missing values kept."""
    return regional.unpivot("region", _PCT, "service", "value")
