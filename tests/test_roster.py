from datetime import date

import pytest

from support import rows
from muster.operators import roster as r

D = date(2023, 12, 1)
OLD = date(2023, 11, 1)
LIST = (
    "fcode string, snapshot_month date, postcode string, stp_code string, icb_name string, hwb string, "
    "trading_name string, organisation_name string"
)
CONTRACT = (
    "fcode string, contractor_type string, contract_type string, stp string, region_code string, "
    "region_name string, end_date date"
)


def listed(fcode, month=D, stp="Q01"):
    return (fcode, month, "AB1", stp, "area", "hwb", f"shop {fcode}", "org")


def contract(fcode, kind="Community", stp="Q01", region="London", end=None, type_="Pharmacy"):
    return (fcode, type_, kind, stp, "Y1", region, end)


@pytest.fixture(scope="module")
def built(frame):
    pharm_list = frame(
        LIST, listed("A"), listed("A", OLD), listed("B", stp="Q62"), listed("C"), listed("D"), listed("E"),
        listed("F"), listed("G"), listed(None),
    )
    contracts = frame(
        CONTRACT,
        contract("A"), contract("A"), contract("B", stp="Q62", region=None), contract("C", kind="DAC"),
        contract("D", kind=None), contract("E", end=OLD), contract("F", type_="Appliance"), contract(None),
    )
    hundred = frame("fcode string, hundred_hour string", ("A", "Yes"), ("B", "No"))
    icb = frame("icb_code string, short_icb_name string", ("Q01", "one"), ("QRV", None))
    contractor = r.latest_contractor(contracts)
    return contractor, r.roster_latest(pharm_list, hundred, contractor, icb), icb, pharm_list, hundred


def test_latest_contractor_drops_closed_other_and_repeated(built):
    codes = [row.fcode for row in built[0].collect()]
    assert sorted(codes, key=str) == ["A", "B", "C", "D", None]


def test_roster_keeps_contracted_providers_of_the_latest_month(built):
    got = rows(built[1].select("fcode", "stp", "stp_code", "region_name", "hundred_hour", "icb"))
    assert got == [
        ("A", "Q01", "Q01", "London", "Yes", "Q01: one"),
        ("B", "QRV", "QRV", "Region Unknown", "No", "QRV: NA"),
        (None, "Q01", "Q01", "London", None, "Q01: one"),
    ]


def test_totals_count_a_missing_code_once(built):
    roster, icb = built[1], built[2]
    assert r.total_contractors(roster).first()[0] == 3
    assert r.total_100_hour(roster).first()[0] == 1
    assert rows(r.icb_totals(roster, icb)) == [("Q01", 2, "one", "Q01: one"), ("QRV", 1, None, "QRV: NA")]
    assert rows(r.icb_totals_100_hour(roster)) == [("Q01", 1)]
    assert r.roster_date(roster).first()[0] == "2023-12-01"


def test_undated_list_row_is_an_error(built, frame):
    contractor, _, icb, pharm_list, hundred = built
    undated = pharm_list.unionByName(frame(LIST, listed("Z", None)))
    with pytest.raises(Exception, match="without a snapshot month"):
        r.roster_latest(undated, hundred, contractor, icb).count()


def test_latest_month_is_read_alone(built, spark, tmp_path):
    contractor, roster, icb, pharm_list, hundred = built
    path = str(tmp_path / "list")
    pharm_list.write.partitionBy("snapshot_month").parquet(path)
    again = r.roster_latest(spark.read.schema(pharm_list.schema).parquet(path), hundred, contractor, icb)
    assert rows(again.select(sorted(roster.columns))) == rows(roster.select(sorted(roster.columns)))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_month" in plan and "Subquery" in plan


def test_contract_filter_makes_the_join_inner(built):
    plan = built[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" in plan
