from datetime import date

import pytest

from support import rows
from muster.operators import registrations as g

D1, D2, D3 = date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1)


def test_deregistrations_take_effect(frame):
    dereg = frame("ods_code string, service_end date", ("A", D2), ("B", D3), ("C", None))
    assert rows(g.active_deregistrations(dereg, D2)) == [("A", D2)]


def test_registrations_since_the_cutoff_count_as_opted_in(frame):
    opt = frame("ods_code string, opted_in boolean, opt_in_date date", ("A", False, D1))
    reg = frame("fcode string, reg_date date", ("B", D2), ("C", D1), ("D", D3), ("E", None), (None, D3))
    dereg = frame("ods_code string, service_end date", ("D", D1), ("B", D3), (None, D1))
    got = g.contraception_opt_ins(opt, reg, dereg, since=D2, as_of=D2)
    assert got.columns == ["ods_code", "opted_in", "opt_in_date"]
    assert rows(got) == [("A", False, D1), ("B", True, D2)]


def test_sources_must_have_the_same_columns(frame):
    opt = frame("ods_code string, opted_in boolean, opt_in_date date, name string", ("A", True, D1, "x"))
    reg = frame("fcode string, reg_date date", ("B", D2))
    dereg = frame("ods_code string, service_end date", ("D", D1))
    with pytest.raises(Exception, match="name"):
        g.contraception_opt_ins(opt, reg, dereg, D2, D2)


@pytest.fixture(scope="module")
def bp(frame):
    bp = frame(
        "fcode string, reg_date date, icb_code string",
        ("A", D1, "Q"), ("A", D3, "Q"), ("B", D3, "Q"), ("X", D3, "Q"), (None, D1, "Q"), ("C", None, "Q"),
    )
    roster = frame("fcode string, snapshot_month date", ("A", D2), ("B", D2), ("C", D2), ("Z", D2))
    return g.bp_registrations(bp, roster)


def test_bp_flag(bp):
    assert rows(bp.select("fcode", "snapshot_month").distinct()) == [
        ("A", D2), ("B", D2), ("C", D2), ("X", None), (None, None),
    ]


def test_bp_metrics(bp):
    got = g.bp_metrics(bp, D2).first().asDict()
    assert got == {"total": 5, "invalid": 2, "old_registrations": 1, "new_registrations": 2, "last_date": None}
    assert g.bp_metrics(bp.where("reg_date is not null"), D2).first().last_date == "2024-01-01"
    assert tuple(g.bp_metrics(bp.where("false"), D2).first())[:4] == (0, 0, 0, 0)
    assert g.bp_metrics(bp.unionAll(bp), D2).first().asDict() == got


def test_each_service_has_its_own_latest_report(frame):
    regs = frame(
        "fcode string, service string, date_reported date, registration_date date",
        ("A", "s", D1, D1), ("B", "s", D2, D1), ("C", "t", D3, D1), ("D", "s", D2, None),
    )
    assert [r.fcode for r in g.latest_registrations(regs, "s").orderBy("fcode").collect()] == ["B", "D"]
    assert g.latest_registrations(regs, "none").count() == 0


def test_valid_signups(frame):
    deregs = frame(
        "fcode string, service string, date_reported date, re_registration_date date",
        ("A", "s", D2, None), ("A", "s", D2, None), ("B", "s", D2, D3), ("C", "s", D1, None), (None, "s", D2, None),
    )
    gone = g.latest_deregistrations(deregs, "s")
    assert rows(gone) == [("A", 1), (None, 1)]
    regs = frame(
        "fcode string, service string, date_reported date, registration_date date",
        ("A", "s", D2, D1), ("B", "s", D2, D1), ("B", "s", D2, D2), ("C", "s", D2, None), (None, "s", D2, D1),
        ("OFF", "s", D2, D1),
    )
    roster = frame("fcode string, stp string", ("A", "Q"), ("B", "Q"), ("C", "Q"), (None, "Q"))
    valid = g.signup_valid(regs, gone, roster)
    assert rows(valid.select("fcode", "registration_date")) == [("B", D1), ("B", D2), ("C", None)]
    facts = g.signup_facts(regs, gone, roster)
    assert rows(facts.select("fcode", "check_reg", "registration_date")) == [("B", True, D1), ("C", False, None)]


def test_last_dates(frame):
    a = frame("opt_in_date date", (D1,), (D2,))
    b = frame("opt_in_date date", (D3,), (None,))
    assert tuple(g.last_dates(a, b).first()) == ("2023-12-01", None)
    assert tuple(g.last_dates(a, b, na_rm=True).first()) == ("2023-12-01", "2024-01-01")
