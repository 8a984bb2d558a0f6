"""Reconciling the opt-in list with the registration list of another service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster import labels
from muster.functions import pct
from muster.operators.joins import first_by, na_join

_ROSTER_DETAIL = ["stp", "trading_name", "organisation_name", "region_name", "region_code"]


def reconcile(opt_in: DataFrame, signups: DataFrame, roster: DataFrame) -> DataFrame:
    """Row-level comparison: every opt-in row with every valid sign-up row of the provider, either side alone.

    ``opt_in`` tells whether the row has an opt-in date, ``check_reg`` whether it has a registration date,
    ``mismatch`` whether the list's own claim disagrees (NULL where the list makes no claim). The area is
    the list's own, filled from the roster.
    """
    left = opt_in.select(
        F.col("ods_code").alias("fcode"), "opt_in_date", "registered_for_cpcs", "icb_code"
    )
    right = signups.select("fcode", "service", "registration_date")
    both = na_join(left, right, "fcode", "full", hot_keys=True)
    return _judge(both.withColumns(
        {"opt_in": F.col("opt_in_date").isNotNull(), "check_reg": F.col("registration_date").isNotNull()}
    ), roster)


_LIST, _SIGNED, _ROSTER = "list", "signed", "roster"


def _factors(opt_in: DataFrame, signups: DataFrame, roster: DataFrame) -> DataFrame:
    """Distinct facts of each side with their rows, and beside each how many rows every side has for the provider."""
    day, text = F.lit(None).cast("date"), F.lit(None).cast("string")
    listed = opt_in.select(
        F.col("ods_code").alias("fcode"), F.lit(_LIST).alias("side"), "opt_in_date", "registered_for_cpcs", "icb_code",
        text.alias("service"), day.alias("registration_date"),
    )
    nothing = [day.alias("opt_in_date"), F.lit(None).cast("boolean").alias("registered_for_cpcs"), text.alias("icb_code")]
    signed = signups.select("fcode", F.lit(_SIGNED).alias("side"), *nothing, "service", "registration_date")
    known = roster.select("fcode", F.lit(_ROSTER).alias("side"), *nothing, text.alias("service"), day.alias("registration_date"))
    rows = listed.unionByName(signed).unionByName(known)
    folded = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n_rows"))
    provider = Window.partitionBy("fcode")

    def rows_of(rule) -> Column:
        return F.coalesce(F.sum(F.when(rule, F.col("n_rows"))).over(provider), F.lit(0))

    dated = F.col("registration_date").isNotNull()
    return folded.withColumns(
        {
            "n_list": rows_of(F.col("side") == _LIST),
            "n_dated": rows_of((F.col("side") == _SIGNED) & dated),
            "n_undated": rows_of((F.col("side") == _SIGNED) & ~dated),
            "n_roster": rows_of(F.col("side") == _ROSTER),
        }
    )


def reconcile_factors(opt_in: DataFrame, signups: DataFrame, roster: DataFrame) -> DataFrame:
    """:func:`reconcile` without its pairs: the distinct facts of each side, the rows that have each (``n_rows``) and the
    rows of the provider on the other side (``n_other``). A fact stands for ``n_rows * max(n_other, 1)`` rows of the pairs
    (before roster details), so a provider with m and n rows takes m + n at most, where the pairs take m * n.

    A NULL code on either side is a provider like any other."""
    signed = F.col("n_dated") + F.col("n_undated")
    sides = _factors(opt_in, signups, roster).where(F.col("side") != _ROSTER)
    return sides.select(
        "fcode", "side", "opt_in_date", "registered_for_cpcs", "icb_code", "service", "registration_date", "n_rows",
        F.when(F.col("side") == _LIST, signed).otherwise(F.col("n_list")).alias("n_other"),
    )


def reconcile_counts(opt_in: DataFrame, signups: DataFrame, roster: DataFrame) -> DataFrame:
    """How many rows :func:`reconcile` has by (opt_in, check_reg, mismatch), from the facts of each side."""
    facts = _factors(opt_in, signups, roster)
    listed, times = F.col("side") == _LIST, F.greatest("n_roster", F.lit(1))
    alone = F.col("n_dated") + F.col("n_undated") == 0
    own, claim = F.col("registration_date").isNotNull(), F.col("registered_for_cpcs")

    def row(check, rows) -> Column:
        opted = listed & F.col("opt_in_date").isNotNull()
        return F.struct(opted.alias("opt_in"), check.alias("check_reg"), (claim != check).alias("mismatch"), rows.alias("n"))

    n = F.col("n_rows") * times
    pairs = F.array(
        row(F.lit(True), F.when(listed, n * F.col("n_dated")).when(own & (F.col("n_list") == 0), n)),
        row(F.lit(False), F.when(listed, n * F.when(alone, F.lit(1)).otherwise(F.col("n_undated"))).when(~own & (F.col("n_list") == 0), n)),
    )
    told = facts.where(F.col("side") != _ROSTER).select(F.inline(pairs)).where("n > 0")
    return told.groupBy("opt_in", "check_reg", "mismatch").agg(F.sum("n").alias("n_rows"))


def reconcile_evidence(opt_in: DataFrame, facts: DataFrame, roster: DataFrame) -> DataFrame:
    """What the counts need of :func:`reconcile`, without pairing repeated rows.

    ``facts`` is the result of ``signup_facts``. Both lists and the roster fold to their distinct facts per provider before they meet, so a provider
    with millions of rows on both sides joins a handful of rows. Every combination of (provider, area,
    opt_in, check_reg, mismatch, roster details) of the row-level result is there, with its earliest
    registration date; a combination may repeat where a list's area equals the roster's.
    """
    left = opt_in.select(
        F.col("ods_code").alias("fcode"),
        F.col("opt_in_date").isNotNull().alias("opt_in"),
        "registered_for_cpcs",
        "icb_code",
    ).distinct()
    both = na_join(left, facts, "fcode", "full").withColumns(
        {"opt_in": F.coalesce("opt_in", F.lit(False)), "check_reg": F.coalesce("check_reg", F.lit(False))}
    )
    return _judge(both, roster.select("fcode", *_ROSTER_DETAIL).distinct())


def _judge(both: DataFrame, roster: DataFrame) -> DataFrame:
    judged = both.withColumn("mismatch", F.col("registered_for_cpcs") != F.col("check_reg"))
    clash = [c for c in roster.columns if c in judged.columns and c != "fcode"]
    detail = roster.drop(*clash)
    return na_join(judged, detail, "fcode", "left").withColumn("icb_code", F.coalesce("icb_code", "stp"))


def signup_valid_count(signups: DataFrame, reconciled: DataFrame) -> DataFrame:
    """Distinct valid sign-ups plus distinct providers whose claim disagrees, in either direction."""
    signed = signups.select("fcode", F.lit(False).alias("is_mismatch"))
    differing = reconciled.where(F.col("mismatch")).select("fcode", F.lit(True).alias("is_mismatch"))
    distinct = signed.unionByName(differing).distinct()
    return distinct.agg(
        F.count_if(~F.col("is_mismatch")).alias("valid_signups"),
        F.count_if("is_mismatch").alias("mismatches"),
        F.count(F.lit(1)).alias("signup_valid"),
    )


def reconcile_by_icb(reconciled: DataFrame, icb_totals: DataFrame) -> DataFrame:
    """Per area: signed up but not opted in, and opted in but not registered, each with its percentage.

    Only areas with at least one provider signed up but not opted in are kept.
    """
    missing_opt_in = ~F.col("opt_in")
    missing_registration = (~F.col("mismatch")) & (~F.col("check_reg"))
    per_provider = reconciled.groupBy("icb_code", "fcode").agg(
        F.max(F.when(missing_opt_in, F.lit(1))).alias("a"),
        F.max(F.when(missing_registration, F.lit(1))).alias("b"),
    )
    per_area = (
        per_provider.groupBy("icb_code")
        .agg(
            F.sum("a").cast("long").alias("signed_not_opted"),
            F.sum("b").cast("long").alias("opted_not_registered"),
        )
        .where(F.col("signed_not_opted").isNotNull())
        .withColumn("icb_code", F.coalesce("icb_code", F.lit(labels.UNKNOWN_AREA_RECONCILE)))
    )
    with_total = na_join(per_area, icb_totals.select("icb_code", "total_contractors"), "icb_code", "left")
    return with_total.select(
        "icb_code",
        "signed_not_opted",
        pct("signed_not_opted", "total_contractors", 0).alias("pct_signed_not_opted"),
        "opted_not_registered",
        pct("opted_not_registered", "total_contractors", 0).alias("pct_opted_not_registered"),
    )


def reconcile_pharmacy_list(reconciled: DataFrame) -> DataFrame:
    """One row per provider signed up but not opted in, earliest registration first, then area."""
    names = ["trading_name", "organisation_name", "region_name", "region_code"]
    signed_only = reconciled.where(~F.col("opt_in"))
    chosen = first_by(signed_only, ["fcode"], ["registration_date", "icb_code", *names])
    return chosen.select(
        "fcode",
        *names,
        F.coalesce("icb_code", F.lit(labels.UNKNOWN_AREA_RECONCILE)).alias("icb_code"),
    )
