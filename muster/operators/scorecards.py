"""National, regional and area scorecards of service uptake.

Sign-ups of all lists and the roster's own rows are laid in one table and folded to one row per service,
provider and group, map side first. Only then do the rows of a provider meet, to learn whether it is on
the roster; by that time a provider holds a handful of rows however often it signed up. The counts that
follow are plain sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster import labels
from muster.functions import pct, short_label, sum_or_zero, week_floor
from muster.operators.joins import na_join
from muster.operators.roster import with_area_label

# Marks the roster's own rows among the sign-ups.
ROSTER = "roster"


def service_facts(
    pharm1st: DataFrame,
    contraception: DataFrame,
    bp: DataFrame,
    roster: DataFrame,
    since: date,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per (service, provider, *by), the roster being a service of its own.

    ``by`` may hold ``icb_code`` (the roster's area is its contract's) and ``week`` (NULL for the roster).
    Opt-in lists give their opted-in rows, the blood-pressure list its rows since ``since``. ``is_yes`` is
    the row's own 100-hour flag. A NULL provider is a provider like any other.
    """

    def shaped(df: DataFrame, service: str, fcode: str, groups: Mapping[str, Column], yes: Column) -> DataFrame:
        return df.select(
            F.lit(service).alias("service"),
            F.col(fcode).alias("fcode"),
            *[groups[c].alias(c) for c in by],
            yes.alias("is_yes"),
        )

    def signups(df: DataFrame, service: str, fcode: str, day: str) -> DataFrame:
        groups = {"icb_code": F.col("icb_code"), "week": week_floor(day)}
        return shaped(df, service, fcode, groups, F.lit(False))

    own_groups = {"icb_code": F.col("stp"), "week": F.lit(None).cast("date")}
    own_flag = F.coalesce(F.col("hundred_hour") == labels.HUNDRED_HOUR_YES, F.lit(False))
    rows = [
        signups(pharm1st.where("opted_in"), labels.PHARM1ST, "ods_code", "opt_in_date"),
        signups(contraception.where("opted_in"), labels.CONTRACEPTION, "ods_code", "opt_in_date"),
        signups(bp.where(F.col("reg_date") >= F.lit(since)), labels.BP, "fcode", "reg_date"),
        shaped(roster, ROSTER, "fcode", own_groups, own_flag),
    ]
    return refold(reduce(DataFrame.unionByName, rows), by)


def refold(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Service facts at a coarser grain."""
    return facts.groupBy("service", "fcode", *by).agg(F.max("is_yes").alias("is_yes"))


def with_provider_flags(facts: DataFrame) -> DataFrame:
    """Add to every fact whether its provider is ``on_roster`` and ``is_100_hour`` there."""
    provider = Window.partitionBy("fcode")
    return facts.withColumns(
        {
            "on_roster": F.max(F.col("service") == ROSTER).over(provider),
            "is_100_hour": F.max("is_yes").over(provider),
        }
    )


def _is(service: str) -> Column:
    return F.col("service") == service


def _measures() -> dict[str, Column]:
    """How each count picks its rows out of flagged service facts."""
    return {
        "total_contractors": _is(ROSTER),
        "total_100_hour": _is(ROSTER) & F.col("is_yes"),
        "pharm1st_opted_in": _is(labels.PHARM1ST),
        "contraception_opted_in": _is(labels.CONTRACEPTION),
        "bp_new": _is(labels.BP) & F.col("on_roster"),
        "pharm1st_100_hour": _is(labels.PHARM1ST) & F.col("is_100_hour"),
    }


def _rated(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "pct_pharm1st": pct("pharm1st_opted_in", "total_contractors", 1),
            "pct_contraception": pct("contraception_opted_in", "total_contractors", 1),
            "pct_pharm1st_100_hour": pct("pharm1st_100_hour", "total_100_hour", 1),
        }
    )


_CARD = [
    "total_contractors",
    "pharm1st_opted_in",
    "pct_pharm1st",
    "contraception_opted_in",
    "pct_contraception",
    "bp_new",
    "total_100_hour",
    "pharm1st_100_hour",
    "pct_pharm1st_100_hour",
]


def national_scorecard(
    pharm1st: DataFrame, contraception: DataFrame, bp: DataFrame, roster: DataFrame, since: date
) -> DataFrame:
    """One row with the nine national measures."""
    return national_from_facts(service_facts(pharm1st, contraception, bp, roster, since))


def national_from_facts(facts: DataFrame) -> DataFrame:
    """National measures from facts with one row per service and provider."""
    counted = with_provider_flags(facts).agg(*[F.count_if(rule).alias(name) for name, rule in _measures().items()])
    return _rated(counted).select(*_CARD)


def headline_values(national: DataFrame) -> DataFrame:
    """The five numbers quoted in the headline text."""
    return national.select(
        "pharm1st_opted_in",
        "pharm1st_100_hour",
        "pct_pharm1st",
        "contraception_opted_in",
        "pct_contraception",
    )


def region_map(contractor: DataFrame) -> DataFrame:
    """Area to region, from the open contracts as they stand (no recode); an area may have two regions."""
    return contractor.select(F.col("stp").alias("icb_code"), "region_code", "region_name").distinct()


def icb_scorecard(
    pharm1st: DataFrame,
    contraception: DataFrame,
    bp: DataFrame,
    roster: DataFrame,
    icb: DataFrame,
    contractor: DataFrame,
    since: date,
    keep_all_areas: bool = False,
) -> DataFrame:
    """Per area: totals, sign-ups per service, 100-hour counts, percentages, region and label.

    Areas without a 100-hour provider are left out unless ``keep_all_areas``. A service without any
    sign-up in an area is NULL there, not 0. Sign-ups count by the area on their list, and are not
    limited to roster providers, so a percentage may exceed 100.
    """
    facts = service_facts(pharm1st, contraception, bp, roster, since, ["icb_code"])
    return icb_from_facts(facts, icb, contractor, keep_all_areas)


def icb_from_facts(
    facts: DataFrame, icb: DataFrame, contractor: DataFrame, keep_all_areas: bool = False
) -> DataFrame:
    """Area scorecard from facts with one row per service, provider and area."""
    one = F.lit(1).cast("long")
    counted = with_provider_flags(facts).groupBy("icb_code").agg(
        *[F.sum(F.when(rule, one)).alias(name) for name, rule in _measures().items()]
    )
    known = F.col("total_contractors" if keep_all_areas else "total_100_hour").isNotNull()
    card = na_join(counted.where(known), with_area_label(icb), "icb_code")
    card = na_join(card, region_map(contractor), "icb_code")
    return _rated(card).select("icb_code", "short_icb_name", "icb", "region_code", "region_name", *_CARD)


def by_uptake(code: str) -> list[Column]:
    """Report order: highest uptake first, missing last, code as tie-break."""
    return [F.col("pct_pharm1st").desc_nulls_last(), F.col(code).asc_nulls_last()]


def icb_display(icb_card: DataFrame) -> DataFrame:
    """The area sheet: label, region and measures, sorted by uptake."""
    return icb_card.orderBy(*by_uptake("icb_code")).select("icb", "region_name", *_CARD)


def regional_scorecard(
    icb_card: DataFrame,
    region_labels: Mapping[str, str] = labels.REGION_SHORT,
    other: str = labels.REGION_SHORT_OTHER,
) -> DataFrame:
    """Area scorecard summed by region, percentages from the sums, regions under short labels."""
    sums = [
        "total_contractors",
        "pharm1st_opted_in",
        "contraception_opted_in",
        "bp_new",
        "total_100_hour",
        "pharm1st_100_hour",
    ]
    summed = icb_card.groupBy("region_name").agg(*[sum_or_zero(c).cast("long").alias(c) for c in sums])
    return _rated(summed).orderBy(*by_uptake("region_name")).select(
        short_label("region_name", region_labels, other).alias("region"), *_CARD
    )


def region_icb_detail(icb_card: DataFrame, reconcile_icb: DataFrame, region: str | None = None) -> DataFrame:
    """Area scorecard with its reconciliation, for one region or for all of them at once."""
    return shown_detail(na_join(icb_card, reconcile_icb, "icb_code", "left"), region)


def shown_detail(detail: DataFrame, region: str | None = None) -> DataFrame:
    """The columns and order of the area detail."""
    order = by_uptake("icb_code")
    if region is None:
        order = [F.col("region_name").asc_nulls_last(), *order]
    else:
        detail = detail.where(F.col("region_name") == region)
    return detail.orderBy(*order).select(
        "region_name",
        F.coalesce("icb", F.lit(labels.UNKNOWN_AREA_DETAIL)).alias("icb"),
        "total_contractors",
        "pharm1st_opted_in",
        "pct_pharm1st",
        "signed_not_opted",
        "pct_signed_not_opted",
        "opted_not_registered",
        "pct_opted_not_registered",
        "contraception_opted_in",
        "pct_contraception",
        "bp_new",
        "total_100_hour",
        "pharm1st_100_hour",
        "pct_pharm1st_100_hour",
    )
