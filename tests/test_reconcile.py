from datetime import date

import pytest
from pyspark.sql import functions as F

from support import rows
from muster.operators import reconcile as c

D1, D2 = date(2023, 11, 1), date(2023, 12, 1)
OPT = "ods_code string, opt_in_date date, registered_for_cpcs boolean, icb_code string"
SIGN = "fcode string, service string, registration_date date"
ROSTER = (
    "fcode string, stp string, trading_name string, organisation_name string, region_name string, region_code string"
)


@pytest.fixture(scope="module")
def lists(frame):
    opt = frame(
        OPT,
        ("A", D1, True, "Q1"),  # on both lists, claim agrees
        ("B", D1, False, None),  # opted in, not registered, area from the roster
        ("C", D1, True, "Q1"),  # claims a registration that is not there
        ("D", D1, None, "Q2"),  # no claim
        ("E", None, False, "Q2"),  # listed without a date, registered in fact
        (None, D1, True, "Q1"),  # no code
        ("A", D2, True, "Q1"),
    )
    signs = frame(
        SIGN, ("A", "s", D1), ("A", "s", D2), ("E", "s", D1), ("F", "s", D1), ("G", "s", None), ("H", "s", D2)
    )
    roster = frame(
        ROSTER,
        *[(k, "Q9", f"shop {k}", "org", "London", "Y1") for k in ("A", "B", "E", "F", "G")],
    )
    return opt, signs, roster


@pytest.fixture(scope="module")
def both(lists, frame):
    opt, signs, roster = lists
    facts = signs.groupBy("fcode", F.col("registration_date").isNotNull().alias("check_reg")).agg(
        F.min("registration_date").alias("registration_date")
    )
    return c.reconcile(opt, signs, roster), c.reconcile_evidence(opt, facts, roster)


def test_row_level_flags(both):
    got = rows(both[0].select("fcode", "opt_in", "check_reg", "mismatch", "icb_code").distinct())
    assert got == [
        ("A", True, True, False, "Q1"),
        ("B", True, False, False, "Q9"),
        ("C", True, False, True, "Q1"),
        ("D", True, False, None, "Q2"),
        ("E", False, True, True, "Q2"),
        ("F", False, True, None, "Q9"),
        ("G", False, False, None, "Q9"),
        ("H", False, True, None, None),
        (None, True, False, True, "Q1"),
    ]
    assert both[0].where("fcode = 'A'").count() == 4


def test_evidence_holds_the_same_facts_in_fewer_rows(both):
    flags = ["fcode", "opt_in", "check_reg", "mismatch", "icb_code", "trading_name"]
    assert rows(both[0].select(flags).distinct()) == rows(both[1].select(flags).distinct())
    assert both[1].where("fcode = 'A'").count() == 1


@pytest.mark.parametrize("which", [0, 1])
def test_results_from_rows_and_from_evidence_agree(both, lists, frame, which):
    data, signs = both[which], lists[1]
    counted = c.signup_valid_count(signs, data).first()
    assert tuple(counted) == (5, 3, 8)
    totals = frame("icb_code string, total_contractors long", ("Q1", 10), ("Q2", 8), ("Q9", 0), (None, 7))
    assert rows(c.reconcile_by_icb(data, totals)) == [
        ("ICB unknown", 1, None, None, None),
        ("Q2", 1, 12.0, None, None),
        ("Q9", 2, None, 1, None),
    ]
    assert rows(c.reconcile_pharmacy_list(data)) == [
        ("E", "shop E", "org", "London", "Y1", "Q2"),
        ("F", "shop F", "org", "London", "Y1", "Q9"),
        ("G", "shop G", "org", "London", "Y1", "Q9"),
        ("H", None, None, None, None, "ICB unknown"),
    ]


def test_nothing_signed_up(lists, frame):
    opt, _, roster = lists
    none = frame(SIGN, ("A", "s", D1)).where("false")
    data = c.reconcile(opt, none, roster)
    assert rows(data.where("check_reg")) == []
    assert tuple(c.signup_valid_count(none, data).first()) == (0, 3, 3)


def test_provider_repeated_on_both_lists_does_not_multiply(spark):
    n = 4000
    opt = spark.range(n).selectExpr(
        "if(id % 2 = 0, 'HOT', cast(id as string)) as ods_code", "date'2023-12-01' as opt_in_date",
        "true as registered_for_cpcs", "'Q1' as icb_code",
    )
    facts = (
        spark.range(n)
        .selectExpr("if(id % 2 = 0, 'HOT', cast(id as string)) as fcode", "date'2023-11-01' as registration_date")
        .groupBy("fcode", F.lit(True).alias("check_reg"))
        .agg(F.min("registration_date").alias("registration_date"))
    )
    roster = spark.range(1).selectExpr(
        "'HOT' as fcode", "'Q1' as stp", "'t' as trading_name", "'o' as organisation_name", "'r' as region_name",
        "'c' as region_code",
    )
    assert c.reconcile_evidence(opt, facts, roster).count() == n // 2 + 1
