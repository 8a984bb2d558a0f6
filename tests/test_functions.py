"""Rules of the column helpers, one small frame per rule."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from support import rows
from muster.functions import (
    bng_to_wgs84,
    date_text,
    has_prefix,
    label,
    max_na,
    min_na,
    month_stamp,
    n_distinct,
    parse_date,
    pct,
    recode,
    short_label,
    sum_or_zero,
    week_floor,
)


def test_distinct_counts_null_once(frame):
    df = frame("g string, x string", ("a", "1"), ("a", "1"), ("a", None), ("a", None), ("b", None), ("c", "2"))
    assert rows(df.groupBy("g").agg(n_distinct("x"))) == [("a", 2), ("b", 1), ("c", 1)]
    assert df.where("false").agg(n_distinct("x")).first()[0] == 0


def test_sum_of_nothing_is_zero(frame):
    df = frame("x int", (None,), (None,))
    assert df.agg(sum_or_zero("x")).first()[0] == 0


def test_extremes_are_null_when_one_value_is(frame):
    df = frame("x int", (1,), (None,), (3,))
    strict = df.agg(max_na("x"), min_na("x")).first()
    relaxed = df.agg(max_na("x", na_rm=True), min_na("x", na_rm=True)).first()
    assert tuple(strict) == (None, None) and tuple(relaxed) == (3, 1)
    assert df.where("x is not null").agg(max_na("x")).first()[0] == 3


@pytest.mark.parametrize(
    "n, d, digits, expected",
    [(1, 8, 0, 12.0), (3, 8, 0, 38.0), (1, 16, 1, 6.2), (3, 16, 1, 18.8), (3, 2, 1, 150.0), (5, 0, 1, None), (None, 5, 1, None)],
)
def test_percentage_rounds_half_to_even_and_survives_zero(frame, n, d, digits, expected):
    assert frame("n long, d long", (n, d)).select(pct("n", "d", digits)).first()[0] == expected


def test_label_writes_missing_parts(frame):
    df = frame("a string, b string", ("x", "y"), (None, "y"), ("x", None), (None, None))
    assert [r[0] for r in df.select(label("a", "b")).collect()] == ["x: y", "NA: y", "x: NA", "NA: NA"]


def test_recode_and_short_label_keep_null(frame):
    df = frame("a string", ("Q62",), ("Q1",), (None,))
    assert [r[0] for r in df.select(recode("a", {"Q62": "QRV"})).collect()] == ["QRV", "Q1", None]
    assert [r[0] for r in df.select(recode("a", {})).collect()] == ["Q62", "Q1", None]
    assert [r[0] for r in df.select(short_label("a", {"Q1": "one"}, "rest")).collect()] == ["rest", "one", None]


def test_prefix_ignores_case(frame):
    df = frame("a string", ("Pharmacy First list",), ("other",))
    assert [r[0] for r in df.select(has_prefix("a", "pharmacy first")).collect()] == [True, False]


def test_week_starts_on_sunday(frame):
    days = [date(2023, 12, 2), date(2023, 12, 3), date(2023, 12, 4), date(2023, 12, 9), None]
    df = frame("d date", *[(d,) for d in days])
    sunday = date(2023, 12, 3)
    assert [r[0] for r in df.select(week_floor("d")).collect()] == [date(2023, 11, 26), sunday, sunday, sunday, None]


@pytest.mark.parametrize(
    "text, style, expected",
    [
        ("01/12/2023", "dmy", date(2023, 12, 1)),
        ("1/2/2023", "dmy", date(2023, 2, 1)),
        ("31/12/2023 10:30", "dmy", date(2023, 12, 31)),
        ("31/02/2023", "dmy", None),
        ("2023-12-01", "dmy", None),
        ("soon", "dmy", None),
        ("", "dmy", None),
        (None, "dmy", None),
        ("2023-12-01 00:00:00", "ymd", date(2023, 12, 1)),
        ("2023-2-3", "ymd", date(2023, 2, 3)),
        ("01/12/2023", "ymd", None),
    ],
)
def test_dates_are_read_leniently(frame, text, style, expected):
    assert frame("t string", (text,)).select(parse_date("t", style)).first()[0] == expected


def test_date_text(frame):
    df = frame("d date", (date(2023, 12, 1),))
    assert tuple(df.select(date_text("d"), month_stamp("d")).first()) == ("2023-12-01", "December2023")


def test_grid_matches_the_published_example(frame):
    # Published example point: on the ground within 10 m of 52 39 28.8282 N, 1 42 57.8663 E.
    df = frame("e double, n double", (651409.903, 313177.270), (None, None))
    got = bng_to_wgs84(df, "e", "n").collect()
    lat, lon = 52 + 39 / 60 + 28.8282 / 3600, 1 + 42 / 60 + 57.8663 / 3600
    assert abs(got[0].lat - lat) * 111_200 < 10 and abs(got[0].lon - lon) * 67_500 < 10
    assert got[1].lat is None and got[1].lon is None
    assert bng_to_wgs84(df, "e", "n").columns == ["e", "n", "lon", "lat"]
