"""Registers derived from the benchmark star schema, so that every query runs over its whole tables.

Customers become providers, nations become areas, regions become regions, orders become roster snapshots,
registration reports and the postcode directory, events become sign-ups. Missing values, closed and
excluded contracts, recoded areas, an area in two regions and missing lookups are set from the rows' own
values; no row is left out to make a table smaller.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from muster.sources.inputs import LOOKUPS, SHEETS, STORED, Inputs

AS_OF = date(2024, 1, 31)
SINCE = date(2024, 1, 15)
SERVICE = "1-URGENT"
LONDON = "London"

_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _code(prefix: str, key: str, width: int = 12) -> str:
    """``prefix`` and the number, filled up to ``width`` digits; a longer one keeps all of its digits."""
    digits = f"cast({key} as string)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


def _area(nation: str) -> str:
    return f"case {nation} when 24 then 'Q62' when 23 then 'QRV' else {_code('Q', nation, 2)} end"


_REGION = (
    "case r_regionkey when 0 then 'London' when 1 then 'North West' when 2 then 'Midlands' "
    "when 3 then 'South East' when 4 then 'East Of England' end"
)
# One area lies in two regions.
_MOVED = "n_nationkey = 12 and c_acctbal < 2000"
_REPORTED = [
    f"{_code('F', 'o_custkey')} as fcode",
    "o_orderpriority as service",
    "trunc(cast(o_orderdate as date), 'year') as date_reported",
]

# Parts of a sign-up row; ``k`` is the number carried by the event.
_FCODE = _code("F", "ckey")
_NAMED_CODE = f"case when k <> 41 then {_FCODE} end as ods_code"
_OPTED = "case when k <> 40 then value > 15 end as opted_in"
_DAY = "case when k not between 50 and 52 then d end"
_ICB = f"case when k < 97 then {_area('c_nationkey')} end as icb_code"
_CONTACT = [
    _ICB,
    "case when k not between 60 and 69 then c_name end as name",
    "concat('0', cast(event_id as string)) as phone",
    f"{_code('L', 'c_nationkey', 2)} as lpc_code",
    "case when c_nationkey <> 3 then c_mktsegment end as lpc_name",
]


class _Tables:
    """The registers, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._opened: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._opened:
            # With the schema given, no file is opened before the query runs.
            self._opened[name] = self._spark.read.schema(_SCHEMAS[name]).parquet(f"{self._dir}/{name}.parquet")
        return self._opened[name]

    def ref_contractor(self) -> DataFrame:
        providers = (
            self._table("customer")
            .join(self._table("nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
            .withColumnsRenamed({"c_nationkey": "n_nationkey", "n_regionkey": "r_regionkey"})
            .join(self._table("region"), "r_regionkey")
        )
        return providers.selectExpr(
            f"{_code('F', 'c_custkey')} as fcode",
            "case when c_acctbal < -500 then 'Appliance' else 'Pharmacy' end as contractor_type",
            "case when c_mktsegment = 'MACHINERY' then 'DAC' when c_acctbal between 0 and 300 then null "
            "else 'Community' end as contract_type",
            f"{_area('n_nationkey')} as stp",
            f"case when {_MOVED} then 'Y0' when n_nationkey <> 7 then concat('Y', r_regionkey) end as region_code",
            f"case when {_MOVED} then '{LONDON}' when n_nationkey <> 7 then {_REGION} end as region_name",
            "case when c_acctbal > 9200 then date'2001-01-01' end as end_date",
        )

    def pharm_list(self) -> DataFrame:
        snapshots = (
            self._table("orders")
            .selectExpr("o_custkey as c_custkey", "trunc(cast(o_orderdate as date), 'year') as snapshot_month")
            .distinct()
        )
        return snapshots.join(self._table("customer"), "c_custkey").selectExpr(
            f"{_code('F', 'c_custkey')} as fcode",
            "snapshot_month",
            f"case when c_acctbal >= -400 then {_code('PC', '(c_custkey div 2) * 22')} end as postcode",
            f"case when c_nationkey <> 11 then {_area('c_nationkey')} end as stp_code",
            "concat('Area ', c_nationkey) as icb_name",
            "c_mktsegment as hwb",
            "c_name as trading_name",
            "concat('Group ', c_mktsegment) as organisation_name",
        )

    def hundred_hour(self) -> DataFrame:
        return self._table("customer").selectExpr(
            f"{_code('F', 'c_custkey')} as fcode",
            "case when c_mktsegment = 'HOUSEHOLD' and c_nationkey <> 15 then 'Yes' else 'No' end as hundred_hour",
        )

    def icb_short(self) -> DataFrame:
        return self._table("nation").selectExpr(
            f"case when n_nationkey <> 5 then {_area('n_nationkey')} end as icb_code",
            "case when n_nationkey <> 14 then n_name end as short_icb_name",
        )

    def boundaries(self) -> DataFrame:
        return self._table("nation").selectExpr(
            f"case when n_nationkey <> 9 then {_area('n_nationkey')} end as icb_code",
            "case when n_nationkey <> 16 then n_name end as icb_name",
            """concat('{"type":"Polygon","coordinates":[[[', n_nationkey, ',1.5],[2,', n_regionkey, '],[0,-3]]]}') as geometry""",
        )

    def _events(self, kind: str) -> DataFrame:
        return (
            self._table("events")
            .where(f"event_type = '{kind}'")
            .selectExpr(
                "event_id",
                "value",
                "cast(ts as date) as d",
                "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k",
                "user_id * 10 + event_id % 10 as ckey",
            )
        )

    def _signups(self, kind: str) -> DataFrame:
        providers = self._table("customer").withColumnRenamed("c_custkey", "ckey")
        return self._events(kind).join(providers, "ckey")

    def pharm1st(self) -> DataFrame:
        return self._signups("signup").selectExpr(
            _NAMED_CODE,
            _OPTED,
            f"{_DAY} as opt_in_date",
            "case when k >= 10 then k < 70 end as registered_for_cpcs",
            *_CONTACT,
        )

    def contraception_opt(self) -> DataFrame:
        return self._signups("purchase").selectExpr(_NAMED_CODE, _OPTED, "d as opt_in_date", *_CONTACT)

    def contraception_reg(self) -> DataFrame:
        return self._signups("click").selectExpr(f"{_FCODE} as fcode", f"{_DAY} as reg_date", *_CONTACT)

    def contraception_dereg(self) -> DataFrame:
        return self._events("error").selectExpr(
            f"{_FCODE} as ods_code",
            "d as date_dereg",
            "date_sub(d, 30) as date_notice",
            "case when k < 95 then date_add(d, k) end as service_end",
            "cast(null as string) as icb",
            "cast(null as string) as area",
        )

    def bp_reg(self) -> DataFrame:
        return self._signups("view").selectExpr(
            f"case when k <> 42 then {_FCODE} end as fcode", f"{_DAY} as reg_date", _ICB
        )

    def service_registrations(self) -> DataFrame:
        return self._table("orders").selectExpr(
            *_REPORTED, "case when o_totalprice >= 20000 then cast(o_orderdate as date) end as registration_date"
        )

    def service_deregistrations(self) -> DataFrame:
        return (
            self._table("orders")
            .where("o_orderstatus = 'F'")
            .selectExpr(
                *_REPORTED,
                "case when o_totalprice > 250000 then cast(o_orderdate as date) end as re_registration_date",
            )
        )

    def postcodes(self) -> DataFrame:
        return self._table("orders").selectExpr(
            f"{_code('PC', 'o_orderkey')} as postcode",
            "case when o_totalprice >= 15000 then cast(floor(100000 + o_totalprice) as double) end as easting",
            "case when o_totalprice >= 15000 then cast(50000 + o_orderkey * 6007 % 900000 as double) end as northing",
        )


def sample_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    tables = _Tables(spark, sf_dir)
    return Inputs(**{name: getattr(tables, name) for name in (*STORED, *SHEETS, *LOOKUPS)})
