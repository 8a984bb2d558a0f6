from datetime import date

import pytest

from support import rows
from muster.operators import scorecards as s
from muster.operators import trends as t

BEFORE, SINCE, AFTER = date(2023, 11, 30), date(2023, 12, 1), date(2023, 12, 5)
OPT = "ods_code string, opted_in boolean, opt_in_date date, icb_code string"


@pytest.fixture(scope="module")
def inputs(frame):
    pharm1st = frame(
        OPT,
        ("A", True, AFTER, "Q1"), ("A", True, AFTER, "Q1"), ("B", True, None, "Q1"), ("X", True, AFTER, "Q1"),
        ("Y", True, AFTER, "Q1"), ("C", False, AFTER, "Q2"), ("D", None, AFTER, "Q2"), (None, True, AFTER, "Q1"),
        ("E", True, AFTER, "Q4"),
    )
    contraception = frame(OPT, ("C", True, AFTER, "Q2"), ("C", True, AFTER, "Q1"))
    bp = frame(
        "fcode string, reg_date date, icb_code string",
        ("A", AFTER, "Q1"), ("A", BEFORE, "Q1"), ("B", SINCE, "Q1"), ("X", AFTER, "Q1"), ("C", BEFORE, "Q2"),
    )
    roster = frame(
        "fcode string, stp string, hundred_hour string",
        ("A", "Q1", "Yes"), ("B", "Q1", "No"), ("C", "Q2", "Yes"), ("D", "Q3", None), ("F", "Q5", "Yes"),
        ("F", "Q5", "Yes"),
    )
    icb = frame("icb_code string, short_icb_name string", ("Q1", "one"), ("Q2", "two"), ("Q3", "three"))
    contractor = frame(
        "fcode string, stp string, region_code string, region_name string, contract_type string",
        ("A", "Q1", "Y1", "London", "Community"), ("B", "Q1", "Y1", "London", "DAC"),
        ("C", "Q2", "Y2", "North West", "Community"), ("D", "Q3", "Y1", "London", "Community"),
        ("G", "Q2", "Y3", None, "Community"),
    )
    return pharm1st, contraception, bp, roster, icb, contractor


@pytest.fixture(scope="module")
def card(inputs):
    return s.icb_scorecard(*inputs, SINCE)


def test_national(inputs):
    got = s.national_scorecard(*inputs[:4], SINCE)
    assert got.first().asDict() == {
        "total_contractors": 5,
        "pharm1st_opted_in": 6,
        "pct_pharm1st": 120.0,
        "contraception_opted_in": 1,
        "pct_contraception": 20.0,
        "bp_new": 2,
        "total_100_hour": 3,
        "pharm1st_100_hour": 1,
        "pct_pharm1st_100_hour": 33.3,
    }
    assert tuple(s.headline_values(got).first()) == (6, 1, 120.0, 1, 20.0)


def test_national_of_nothing(inputs):
    got = s.national_scorecard(*[df.where("false") for df in inputs[:4]], SINCE).first()
    assert (got.total_contractors, got.pharm1st_opted_in, got.pct_pharm1st) == (0, 0, None)


def test_area_card(card):
    got = rows(card.select("icb_code", "icb", "region_name", "total_contractors", "pharm1st_opted_in", "pct_pharm1st",
                           "contraception_opted_in", "bp_new", "total_100_hour", "pharm1st_100_hour"))
    assert got == [
        ("Q1", "Q1: one", "London", 2, 5, 250.0, 1, 2, 1, 1),
        ("Q2", "Q2: two", "North West", 1, None, None, 1, None, 1, None),
        ("Q2", "Q2: two", None, 1, None, None, 1, None, 1, None),
        ("Q5", None, None, 1, None, None, None, None, 1, None),
    ]


def test_areas_without_100_hour_providers_on_request(inputs):
    every = s.icb_scorecard(*inputs, SINCE, keep_all_areas=True)
    assert sorted(r.icb_code for r in every.select("icb_code").distinct().collect()) == ["Q1", "Q2", "Q3", "Q5"]


def test_regions_sum_their_areas_and_an_area_in_two_regions_counts_twice(card):
    got = s.regional_scorecard(card)
    assert rows(got.select("region", "total_contractors", "pharm1st_opted_in", "pct_pharm1st", "contraception_opted_in")) == [
        ("LDN", 2, 5, 250.0, 1),
        ("NE", 1, 0, 0.0, 1),
        (None, 2, 0, 0.0, 1),
    ]
    assert [r.region for r in got.collect()][0] == "LDN"
    relabelled = s.regional_scorecard(card, {"North West": "NW"}, "other")
    assert sorted(str(r.region) for r in relabelled.collect()) == ["NW", "None", "other"]


def test_display_order(card):
    shown = [r.icb for r in s.icb_display(card).collect()]
    assert shown == ["Q1: one", "Q2: two", "Q2: two", None]


def test_detail_of_one_region_and_of_all(card, frame):
    recon = frame(
        "icb_code string, signed_not_opted long, pct_signed_not_opted double, opted_not_registered long, "
        "pct_opted_not_registered double",
        ("Q1", 3, 50.0, None, None),
    )
    one = s.region_icb_detail(card, recon, "London")
    assert rows(one.select("icb", "signed_not_opted", "pct_pharm1st")) == [("Q1: one", 3, 250.0)]
    every = s.region_icb_detail(card, recon)
    assert [(r.region_name, r.icb) for r in every.collect()] == [
        ("London", "Q1: one"), ("North West", "Q2: two"), (None, "Q2: two"), (None, "ICB Unknown"),
    ]


def test_weekly_trend(inputs):
    got = t.weekly_trend(*inputs[:4], SINCE)
    first, second = date(2023, 11, 26), date(2023, 12, 3)
    assert rows(got) == sorted(
        [
            (first, 1, "BP check service signup since 01Dec2023"),
            (second, 1, "BP check service signup since 01Dec2023"),
            (second, 1, "Contraception Opt-In"),
            (second, 5, "Pharmacy First Opt-In"),
            (second, 1, "Pharmacy First Opt-In (100-hour phmarcy only)"),
        ]
    ) + [(None, 1, "Pharmacy First Opt-In")]
    assert tuple(t.trend_range(got).first()) == (None, None)
    assert tuple(t.trend_range(got, na_rm=True).first()) == (first, date(2023, 12, 10))


def test_regional_long_keeps_missing_values(frame):
    regional = frame(
        "region string, total_contractors long, pct_pharm1st double, pct_pharm1st_100_hour double, pct_contraception double",
        ("LDN", 1, 10.0, None, 5.0),
    )
    assert sorted(map(tuple, t.regional_long(regional).collect())) == [
        ("LDN", "pct_contraception", 5.0), ("LDN", "pct_pharm1st", 10.0), ("LDN", "pct_pharm1st_100_hour", None),
    ]


def test_hot_provider_and_hot_area(spark, inputs):
    """A third of all sign-ups from one provider, half of them in one area: counts stay exact."""
    rows_ = spark.range(60_000)
    pharm1st = rows_.selectExpr(
        "if(id % 3 = 0, 'HOT', concat('P', id % 5000)) as ods_code", "true as opted_in", "date'2023-12-05' as opt_in_date",
        "if(id % 2 = 0, 'Q1', concat('Q', id % 40)) as icb_code",
    )
    got = s.national_scorecard(pharm1st, inputs[1], inputs[2], inputs[3], SINCE).first()
    want = pharm1st.select("ods_code").distinct().count()
    assert got.pharm1st_opted_in == want
