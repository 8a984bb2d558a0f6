"""All lists in one table, folded by provider: counts, dates and reconciliation from a single pass over each list.

The rows of every list and of the roster are laid in one table of (provider, area, facts, days) and folded to one row per
provider (and area, where asked), map side first. Facts are bits, so that a fold is one bitwise sum. What a report needs of several lists at once (who is signed up,
who claims what, until when a list goes) is then read off that row, without a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster import labels
from muster.functions import date_text, pct
from muster.operators.joins import na_join
from muster.operators.roster import with_area_label
from muster.operators.scorecards import region_map

#: What a provider's rows may say, one bit each.
_NAMES = (
    "on_roster", "is_100_hour", "on_pharm1st", "in_pharm1st", "claims", "denies", "in_contraception", "on_bp", "in_bp",
    "registered", "registered_undated", "gone", "undated_pharm1st", "undated_contraception", "undated_bp", "undated_roster",
    # Made from the others when the rows of a provider meet.
    "new_bp", "hundred_pharm1st", "signed_not_opted", "opted_not_registered",
)
BIT = {name: 1 << at for at, name in enumerate(_NAMES)}


def _says(name: str, facts: str = "facts") -> Column:
    return F.col(facts).bitwiseAND(F.lit(BIT[name])) != 0


def _bits(**rules: Column) -> Column:
    """The bits of the rules that hold; a rule that is NULL does not."""
    return reduce(Column.__add__, [F.when(rule, F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in rules.items()])


def list_rows(
    pharm1st: DataFrame,
    contraception: DataFrame,
    bp: DataFrame,
    roster: DataFrame,
    registrations: DataFrame,
    deregistrations: DataFrame,
    since: date,
) -> DataFrame:
    """Every row of every list as fcode, icb_code, facts (bits), and its day in the list's own column."""
    days = ("last_pharm1st", "last_contraception", "last_bp", "last_roster")
    yes, unknown = F.lit(True), F.lit(None).cast("date")

    def rows(df: DataFrame, fcode: str, icb: Column, day: str | None, last: str | None, **rules: Column) -> DataFrame:
        dates = [(F.col(day) if n == last else unknown).alias(n) for n in days]
        return df.select(F.col(fcode).alias("fcode"), icb.alias("icb_code"), _bits(**rules).alias("facts"), *dates)

    claim, opted, missing = F.col("registered_for_cpcs"), F.col("opted_in"), F.col("opt_in_date").isNull()
    signed, no_area, area = F.col("registration_date").isNotNull(), F.lit(None).cast("string"), F.col("icb_code")
    recent, undated = F.col("reg_date") >= F.lit(since), F.col("reg_date").isNull()
    hundred, no_month = F.col("hundred_hour") == labels.HUNDRED_HOUR_YES, F.col("snapshot_month").isNull()
    parts = [
        rows(pharm1st, "ods_code", area, "opt_in_date", "last_pharm1st",
             on_pharm1st=yes, in_pharm1st=opted, claims=claim, denies=~claim, undated_pharm1st=missing),
        rows(contraception, "ods_code", area, "opt_in_date", "last_contraception", in_contraception=opted, undated_contraception=missing),
        rows(bp, "fcode", area, "reg_date", "last_bp", on_bp=yes, in_bp=recent, undated_bp=undated),
        rows(roster, "fcode", F.col("stp"), "snapshot_month", "last_roster", on_roster=yes, is_100_hour=hundred, undated_roster=no_month),
        rows(registrations, "fcode", no_area, None, None, registered=signed, registered_undated=~signed),
        rows(deregistrations, "fcode", no_area, None, None, gone=yes),
    ]
    return reduce(DataFrame.unionByName, parts)


def fold(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per provider (a NULL code being a provider like any other) and ``by``: all that its rows say, and the last
    day of each list."""
    days = [F.max(c).alias(c) for c in rows.columns if c.startswith("last_")]
    return rows.groupBy("fcode", *by).agg(F.bit_or("facts").alias("facts"), *days)


def _signed(facts: str = "facts") -> Column:
    """A registration that counts: not withdrawn, of a provider on the roster."""
    return (_says("registered", facts) | _says("registered_undated", facts)) & ~_says("gone", facts) & _says("on_roster", facts)


def _checks(found: bool, facts: str = "facts") -> Column:
    """Whether some registration of the provider is dated (``found``) or, with none or an undated one, is not."""
    if found:
        return _signed(facts) & _says("registered", facts)
    return ~_signed(facts) | _says("registered_undated", facts)


def headline(folded: DataFrame, na_rm: bool = False) -> DataFrame:
    """Every number of the headline text in one row, from facts with one row per provider: one aggregate."""
    counts = {
        "total_contractors": _says("on_roster"),
        "pharm1st_opted_in": _says("in_pharm1st"),
        "pharm1st_100_hour": _says("in_pharm1st") & _says("is_100_hour"),
        "contraception_opted_in": _says("in_contraception"),
        "bp_total": _says("on_bp"),
        "bp_invalid": _says("on_bp") & ~_says("on_roster"),
        "bp_new": _says("in_bp") & _says("on_roster"),
        "signed": _signed(),
        "mismatches": (_says("claims") & _checks(False)) | (_says("denies") & _checks(True)),
    }

    def last(name: str, ignore: bool = False) -> Column:
        day = date_text(F.max(f"last_{name}"))
        return day if ignore else F.when(~F.max(_says(f"undated_{name}")), day)

    days = {
        "last_pharm1st": last("pharm1st", na_rm),
        "last_contraception": last("contraception", na_rm),
        "last_bp": last("bp"),
        "roster_date": last("roster"),
    }
    one = folded.agg(*[F.count_if(rule).alias(n) for n, rule in counts.items()], *[c.alias(n) for n, c in days.items()])
    return one.select(
        "last_pharm1st",
        "pharm1st_opted_in",
        pct("pharm1st_opted_in", "total_contractors", 1).alias("pct_pharm1st"),
        "pharm1st_100_hour",
        (F.col("signed") + F.col("mismatches")).alias("signup_valid"),
        "roster_date",
        "last_contraception",
        "contraception_opted_in",
        pct("contraception_opted_in", "total_contractors", 1).alias("pct_contraception"),
        "last_bp",
        "bp_total",
        "bp_invalid",
        (F.col("bp_total") - F.col("bp_invalid")).alias("bp_valid"),
        "bp_new",
    )


#: Which bit each count of an area picks its providers by.
_AREA = {
    "total_contractors": "on_roster",
    "total_100_hour": "is_100_hour",
    "pharm1st_opted_in": "in_pharm1st",
    "contraception_opted_in": "in_contraception",
    "bp_new": "new_bp",
    "pharm1st_100_hour": "hundred_pharm1st",
    "signed_not_opted": "signed_not_opted",
    "opted_not_registered": "opted_not_registered",
}


def area_detail(folded: DataFrame, icb: DataFrame, contractor: DataFrame) -> DataFrame:
    """The area scorecard and its reconciliation from facts with one row per provider and area.

    The rows of a provider meet once, in a window over a handful of rows. An opt-in row without an area, and a
    registration without an opt-in row, count in the areas that the roster has for the provider. An opt-in row's part is
    moved there and folded by area again, which needs no shuffle, so a provider counts once in an area.
    """
    provider, no_area = Window.partitionBy("fcode"), F.col("icb_code").isNull()
    whole = folded.select("fcode", "icb_code", "facts").withColumns(
        {
            "all": F.bit_or("facts").over(provider),
            # A set leaves NULL out; whether the roster has the provider in no area is told apart.
            "areas": F.collect_set(F.when(_says("on_roster"), F.col("icb_code"))).over(provider),
            "homeless": F.max(no_area & _says("on_roster")).over(provider),
        }
    )
    # The row-level comparison judges each opt-in row by itself: not dated, or denying while no dated registration is there.
    listed = _bits(signed_not_opted=_says("undated_pharm1st"), opted_not_registered=_says("denies") & _checks(False, "all"))
    known = whole.withColumn("listed", listed)
    stays = ~no_area | F.col("homeless") | ~_says("on_roster", "all")
    unlisted = _bits(signed_not_opted=_signed("all") & ~_says("on_pharm1st", "all") & _says("on_roster"))
    both = _bits(
        new_bp=_says("in_bp") & _says("on_roster", "all"),
        hundred_pharm1st=_says("in_pharm1st") & _says("is_100_hour", "all"),
    )
    here = F.col("facts").bitwiseOR(both).bitwiseOR(F.when(stays, F.col("listed")).otherwise(F.lit(0))).bitwiseOR(unlisted)
    moved = F.when(no_area & (F.col("listed") != 0), F.transform("areas", lambda x: F.struct(x.alias("area"), F.col("listed").alias("facts"))))
    none = F.array().cast("array<struct<area:string,facts:int>>")
    pieces = F.concat(F.array(F.struct(F.col("icb_code").alias("area"), here.alias("facts"))), F.coalesce(moved, none))
    per_area = known.select("fcode", F.inline(pieces))
    per_provider = per_area.groupBy("fcode", F.col("area").alias("icb_code")).agg(F.bit_or("facts").alias("facts"))
    one = F.lit(1).cast("long")
    counted = per_provider.groupBy("icb_code").agg(*[F.sum(F.when(_says(bit), one)).alias(n) for n, bit in _AREA.items()])
    return _detail(counted, icb, contractor)


def _detail(counted: DataFrame, icb: DataFrame, contractor: DataFrame) -> DataFrame:
    # The reconciliation keeps areas with a provider signed up but not opted in, and a known area.
    reconciled = F.col("signed_not_opted").isNotNull() & F.col("icb_code").isNotNull()
    shown = counted.where(F.col("total_100_hour").isNotNull()).withColumns(
        {n: F.when(reconciled, F.col(n)) for n in ("signed_not_opted", "opted_not_registered")}
    )
    card = na_join(na_join(shown, with_area_label(icb), "icb_code"), region_map(contractor), "icb_code")
    rates = {
        "pct_pharm1st": pct("pharm1st_opted_in", "total_contractors", 1),
        "pct_contraception": pct("contraception_opted_in", "total_contractors", 1),
        "pct_pharm1st_100_hour": pct("pharm1st_100_hour", "total_100_hour", 1),
        "pct_signed_not_opted": pct("signed_not_opted", "total_contractors", 0),
        "pct_opted_not_registered": pct("opted_not_registered", "total_contractors", 0),
    }
    return card.withColumns(rates)
