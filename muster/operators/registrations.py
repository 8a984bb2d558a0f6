"""Sign-up lists: opt-ins, registrations, de-registrations and what is still valid."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster import labels
from muster.functions import date_text, max_na
from muster.operators.joins import na_join


def active_deregistrations(dereg: DataFrame, as_of: date) -> DataFrame:
    """De-registrations that have taken effect by ``as_of``."""
    return dereg.where(F.col("service_end") <= F.lit(as_of)).select("ods_code", "service_end")


def contraception_opt_ins(
    opt: DataFrame, reg: DataFrame, dereg: DataFrame, since: date, as_of: date
) -> DataFrame:
    """Opt-ins plus registrations since ``since`` that are not de-registered, the latter counted as opted in."""
    recent = reg.where(F.col("reg_date") >= F.lit(since)).withColumnsRenamed(
        {"fcode": "ods_code", "reg_date": "opt_in_date"}
    )
    kept = na_join(recent, active_deregistrations(dereg, as_of), "ods_code", "left_anti")
    return opt.unionByName(kept.withColumn("opted_in", F.lit(True)))


def bp_registrations(bp: DataFrame, roster: DataFrame) -> DataFrame:
    """Registrations with the roster's snapshot month, NULL for a provider not on the roster."""
    return na_join(bp, roster.select("fcode", "snapshot_month"), "fcode", "left")


def _once(flag: Column) -> Column:
    """Whether any row of the provider meets the condition."""
    return F.coalesce(F.max(F.coalesce(flag, F.lit(False))), F.lit(False))


def _providers(flag: str) -> Column:
    return F.count_if(F.col(flag))


def bp_metrics(bp_flagged: DataFrame, since: date) -> DataFrame:
    """One row: distinct providers in total, off the roster, before and since the cut-off, and the last date.

    One pass: rows fold to one per provider before the counts, and a NULL provider counts once.
    """
    on_roster = F.col("snapshot_month").isNotNull()
    cutoff = F.lit(since)
    per_provider = bp_flagged.groupBy("fcode").agg(
        _once(~on_roster).alias("is_invalid"),
        _once(on_roster & (F.col("reg_date") < cutoff)).alias("is_old"),
        _once(on_roster & (F.col("reg_date") >= cutoff)).alias("is_new"),
        F.max("reg_date").alias("last_date"),
        F.max(F.col("reg_date").isNull()).alias("has_undated"),
    )
    return per_provider.agg(
        F.count(F.lit(1)).alias("total"),
        _providers("is_invalid").alias("invalid"),
        _providers("is_old").alias("old_registrations"),
        _providers("is_new").alias("new_registrations"),
        F.when(~F.max("has_undated"), date_text(F.max("last_date"))).alias("last_date"),
    )


def _latest_report(rows: DataFrame, service: str) -> DataFrame:
    """Rows of a service at that service's own latest report date, found by a scalar subquery."""
    of_service = rows.where(F.col("service") == service)
    return of_service.where(F.col("date_reported") == of_service.agg(F.max("date_reported")).scalar())


def latest_registrations(regs: DataFrame, service: str = labels.CPCS_SERVICE) -> DataFrame:
    return _latest_report(regs, service)


def latest_deregistrations(deregs: DataFrame, service: str = labels.CPCS_SERVICE) -> DataFrame:
    """Distinct providers de-registered at the latest report and not registered again."""
    gone = _latest_report(deregs, service).where(F.col("re_registration_date").isNull())
    return gone.select("fcode", F.lit(1).alias("dereg")).distinct()


def signup_valid(regs: DataFrame, deregs: DataFrame, roster: DataFrame) -> DataFrame:
    """Latest registrations, less the de-registered, that are on the roster; with the roster's columns."""
    current = na_join(regs, deregs, "fcode", "left_anti")
    return na_join(current, roster, "fcode", "inner")


def signup_facts(regs: DataFrame, deregs: DataFrame, roster: DataFrame) -> DataFrame:
    """What reconciliation needs of :func:`signup_valid`: per provider its earliest date, and undated rows apart.

    Registrations fold to at most two rows per provider before they meet the other lists.
    """
    facts = regs.groupBy("fcode", F.col("registration_date").isNotNull().alias("check_reg")).agg(
        F.min("registration_date").alias("registration_date")
    )
    current = na_join(facts, deregs, "fcode", "left_anti")
    return na_join(current, roster, "fcode", "left_semi")


def last_dates(pharm1st: DataFrame, contraception: DataFrame, na_rm: bool = False) -> DataFrame:
    """Latest opt-in date of each list as text; NULL if a list has an undated row, unless ``na_rm``."""

    def last(df: DataFrame, name: str) -> DataFrame:
        return df.agg(date_text(max_na("opt_in_date", na_rm)).alias(name))

    return last(pharm1st, "last_pharm1st").select(
        "last_pharm1st", last(contraception, "last_contraception").scalar().alias("last_contraception")
    )
