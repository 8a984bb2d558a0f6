"""The current roster of providers and its area totals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster import labels
from muster.functions import date_text, label, max_na, recode
from muster.operators.joins import distinct_counts, na_join

_CONTRACT_COLUMNS = ["fcode", "stp", "region_code", "region_name", "contract_type"]


def latest_contractor(ref_contractor: DataFrame) -> DataFrame:
    """Open pharmacy contracts, duplicate rows removed."""
    is_open = F.col("end_date").isNull() & (F.col("contractor_type") == labels.PHARMACY)
    return ref_contractor.where(is_open).select(*_CONTRACT_COLUMNS).distinct()


def with_area_label(icb: DataFrame) -> DataFrame:
    """Area lookup keyed ``icb_code`` with ``short_icb_name`` and the printed label ``icb``."""
    return icb.select("icb_code", "short_icb_name", label("icb_code", "short_icb_name").alias("icb"))


def _latest_snapshot(pharm_list: DataFrame) -> Column:
    """Newest snapshot month as a scalar subquery; an undated row is an error, not an empty roster."""
    month = F.col("snapshot_month")
    undated = F.count(F.lit(1)) > F.count(month)
    failure = F.raise_error(F.lit("provider list holds rows without a snapshot month")).cast("date")
    return pharm_list.agg(F.when(undated, failure).otherwise(F.max(month))).scalar()


def latest_snapshot(pharm_list: DataFrame) -> DataFrame:
    """The provider list's newest month, resolved by a subquery, so that a list stored by month reads that month only."""
    return pharm_list.where(F.col("snapshot_month") == _latest_snapshot(pharm_list))


def roster_latest(
    pharm_list: DataFrame,
    hundred_hour: DataFrame,
    contractor: DataFrame,
    icb: DataFrame,
    recodes: Mapping[str, str] = labels.AREA_RECODES,
    exclude: str = labels.EXCLUDED_CONTRACT,
) -> DataFrame:
    """Latest provider snapshot with 100-hour flag, contract, region and area label.

    The newest month is resolved by a subquery first, so a list stored by month reads that month only.
    Providers without an open contract, or whose contract type is missing or ``exclude``, are left out.
    """
    flagged = na_join(latest_snapshot(pharm_list), hundred_hour.select("fcode", "hundred_hour"), "fcode", "left")
    contracted = na_join(flagged, contractor, "fcode", "left").where(F.col("contract_type") != exclude)
    recoded = contracted.withColumns(
        {
            "stp": recode("stp", recodes),
            "stp_code": recode("stp_code", recodes),
            "region_name": F.coalesce("region_name", F.lit(labels.UNKNOWN_REGION)),
        }
    )
    return na_join(recoded, with_area_label(icb), [("stp_code", "icb_code")], "left")


def total_contractors(roster: DataFrame) -> DataFrame:
    return distinct_counts(roster, [], "fcode", "total_contractors")


def _hundred_hour_only(roster: DataFrame) -> DataFrame:
    return roster.where(F.col("hundred_hour") == labels.HUNDRED_HOUR_YES)


def total_100_hour(roster: DataFrame) -> DataFrame:
    return distinct_counts(_hundred_hour_only(roster), [], "fcode", "total_100_hour")


def icb_totals(roster: DataFrame, icb: DataFrame) -> DataFrame:
    """Providers per area (``icb_code``) with the area's short name and label."""
    counted = distinct_counts(roster, ["stp"], "fcode", "total_contractors")
    return na_join(counted.withColumnRenamed("stp", "icb_code"), with_area_label(icb), "icb_code", "left")


def icb_totals_100_hour(roster: DataFrame) -> DataFrame:
    counted = distinct_counts(_hundred_hour_only(roster), ["stp"], "fcode", "total_100_hour")
    return counted.withColumnRenamed("stp", "icb_code")


def roster_date(roster: DataFrame) -> DataFrame:
    """Snapshot date of the roster as text."""
    return roster.agg(date_text(max_na("snapshot_month")).alias("roster_date"))
