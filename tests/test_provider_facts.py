"""One fold of all lists against the separate operators, and the factorised comparison against its pairs."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from support import rows
from muster.functions import date_text, max_na
from muster.operators import provider_facts as pf
from muster.operators import reconcile as c
from muster.operators import registrations as r
from muster.operators import roster as ro
from muster.operators import scorecards as s

SINCE = date(2023, 12, 1)


def random_lists(frame, seed):
    rng = random.Random(seed)
    codes, areas = [None, *"ABCDEFGHIJKL"], [None, "Q1", "Q2", "Q3"]

    def day():
        return rng.choice([None, *[date(2023, 11, 20) + timedelta(i) for i in range(25)]])

    def some(n, make):
        return [make() for _ in range(n)]

    flag = [True, False, None]
    pharm1st = frame(
        "ods_code string, opted_in boolean, opt_in_date date, registered_for_cpcs boolean, icb_code string",
        *some(45, lambda: (rng.choice(codes), rng.choice(flag), day(), rng.choice(flag), rng.choice(areas))),
    )
    contraception = frame(
        "ods_code string, opted_in boolean, opt_in_date date, icb_code string",
        *some(30, lambda: (rng.choice(codes), rng.choice(flag), day() or SINCE, rng.choice(areas))),
    )
    bp = frame("fcode string, reg_date date, icb_code string", *some(30, lambda: (rng.choice(codes), day(), rng.choice(areas))))
    listed = some(12, lambda: (rng.choice(codes[:-3]), SINCE, rng.choice(areas), rng.choice(["Yes", "No", None]), rng.choice(["n", "m"])))
    roster = frame(
        "fcode string, snapshot_month date, stp string, hundred_hour string, trading_name string, organisation_name string, "
        "region_name string, region_code string",
        *[(*row, "o", "London", "Y1") for row in listed],
    )
    regs = frame("fcode string, service string, registration_date date", *some(30, lambda: (rng.choice(codes), "s", day())))
    gone = frame("fcode string, dereg int", *[(k, 1) for k in rng.sample(codes, 3)])
    icb = frame("icb_code string, short_icb_name string", ("Q1", "one"), ("Q2", None), (None, "none"))
    contractor = frame("stp string, region_code string, region_name string", ("Q1", "Y1", "London"), ("Q2", "Y2", None), (None, "Y3", "x"))
    return pharm1st, contraception, bp, roster, regs, gone, icb, contractor


@pytest.mark.parametrize("seed", range(4))
def test_headline_equals_the_separate_operators(frame, seed):
    pharm1st, contraception, bp, roster, regs, gone, _, _ = random_lists(frame, seed)
    folded = pf.fold(pf.list_rows(pharm1st, contraception, bp, roster, regs, gone, SINCE))
    signups = r.signup_valid(regs, gone, roster.drop("service"))
    pairs = c.reconcile(pharm1st, signups, roster)
    national = s.national_scorecard(pharm1st, contraception, bp, roster, SINCE).first()
    bp_row = r.bp_metrics(r.bp_registrations(bp, roster).distinct(), SINCE).first()
    for na_rm in (False, True):
        got = pf.headline(folded, na_rm).first()
        last = r.last_dates(pharm1st, contraception, na_rm).first()
        assert got.asDict() == {
            "last_pharm1st": last.last_pharm1st,
            "pharm1st_opted_in": national.pharm1st_opted_in,
            "pct_pharm1st": national.pct_pharm1st,
            "pharm1st_100_hour": national.pharm1st_100_hour,
            "signup_valid": c.signup_valid_count(signups.select("fcode").distinct(), pairs).first().signup_valid,
            "roster_date": roster.agg(date_text(max_na("snapshot_month"))).first()[0],
            "last_contraception": last.last_contraception,
            "contraception_opted_in": national.contraception_opted_in,
            "pct_contraception": national.pct_contraception,
            "last_bp": bp_row.last_date,
            "bp_total": bp_row.total,
            "bp_invalid": bp_row.invalid,
            "bp_valid": bp_row.total - bp_row.invalid,
            "bp_new": bp_row.new_registrations,
        }


@pytest.mark.parametrize("seed", range(4))
def test_area_detail_equals_scorecard_beside_reconciliation(frame, seed):
    pharm1st, contraception, bp, roster, regs, gone, icb, contractor = random_lists(frame, seed)
    folded = pf.fold(pf.list_rows(pharm1st, contraception, bp, roster, regs, gone, SINCE), ["icb_code"])
    got = s.shown_detail(pf.area_detail(folded, icb, contractor))
    card = s.icb_scorecard(pharm1st, contraception, bp, roster, icb, contractor, SINCE)
    evidence = c.reconcile_evidence(pharm1st, r.signup_facts(regs, gone, roster), roster)
    want = s.region_icb_detail(card, c.reconcile_by_icb(evidence, ro.icb_totals(roster, icb)))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_headline_of_nothing(frame):
    lists = [df.where("false") for df in random_lists(frame, 0)[:6]]
    got = pf.headline(pf.fold(pf.list_rows(*lists, SINCE))).first()
    assert (got.pharm1st_opted_in, got.pct_pharm1st, got.signup_valid, got.last_bp) == (0, None, 0, None)


@pytest.mark.parametrize("seed", range(3))
def test_factors_stand_for_the_pairs(frame, seed):
    pharm1st, _, _, roster, regs, gone, _, _ = random_lists(frame, seed)
    signups = r.signup_valid(regs, gone, roster.drop("service"))
    # With and without NULL codes on both sides; the random lists have them on each.
    pairs = c.reconcile(pharm1st, signups, roster)
    want = pairs.groupBy("opt_in", "check_reg", "mismatch").agg(F.count(F.lit(1)).alias("n_rows"))
    assert sorted(map(tuple, c.reconcile_counts(pharm1st, signups, roster).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    factors = c.reconcile_factors(pharm1st, signups, roster)
    assert factors.where("fcode IS NULL").groupBy("side").count().count() >= 1
    listed = factors.where("side = 'list'").agg(F.sum(F.col("n_rows") * F.greatest("n_other", F.lit(1)))).first()[0]
    alone = factors.where("side = 'signed' AND n_other = 0").agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    assert listed + alone == c.reconcile(pharm1st, signups, roster.limit(0)).count()


def test_a_provider_hot_on_both_sides_is_never_paired(spark, frame):
    """200,000 rows on one side and 100,000 on the other: 20,000,000,000 pairs, a handful of facts."""
    hot = "if(id % 3 < 2, 'HOT', concat('P', id))"
    pharm1st = spark.range(0, 300_000, 1, 4).selectExpr(
        f"{hot} as ods_code", "true as opted_in", "if(id % 5 = 0, null, date'2023-12-01') as opt_in_date",
        "id % 2 = 0 as registered_for_cpcs", "'Q1' as icb_code",
    )
    signups = spark.range(0, 150_000, 1, 4).selectExpr(f"{hot} as fcode", "'s' as service", "if(id % 4 = 0, null, date'2023-11-01') as registration_date")
    roster = frame("fcode string, stp string", ("HOT", "Q1"))
    got = {tuple(x)[:3]: x.n_rows for x in c.reconcile_counts(pharm1st, signups, roster).collect()}
    assert sum(got.values()) > 200_000 * 100_000
    claiming = sum(1 for i in range(300_000) if i % 3 < 2 and i % 2 == 0)
    dated = sum(1 for i in range(150_000) if i % 3 < 2 and i % 4)
    others = sum(1 for i in range(150_000) if i % 3 == 2 and i % 2 == 0 and i % 4)
    assert got[True, True, False] + got[False, True, False] == claiming * dated + others
    hot_rows = c.reconcile_factors(pharm1st, signups, roster).where("fcode = 'HOT'").collect()
    assert len(hot_rows) == 6 and {x.n_other for x in hot_rows} == {100_000, 200_000}
    assert rows(c.reconcile_counts(pharm1st.limit(0), signups.limit(0), roster)) == []
