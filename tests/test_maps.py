from datetime import date

import pytest
from pyspark.sql import functions as F

from support import rows
from muster.operators import maps as m

D = date(2023, 12, 5)


def classes(spark, values, n=5):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value double")
    breaks = df.agg(m.quantile_breaks("value", n)).scalar()
    out = df.withColumn("b", breaks).withColumn("c", m.quantile_class(F.col("value"), F.col("b"))).orderBy("i")
    got = out.collect()
    return [r.c for r in got], got[0].b


def test_classes_are_closed_on_the_left_and_the_last_on_both_sides(spark):
    got, breaks = classes(spark, [0.0, 1.0, 2.0, 3.0, 4.0, 5.0])
    assert breaks == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0] and got == [1, 2, 3, 4, 5, 5]


def test_limits_are_interpolated(spark):
    assert classes(spark, [1.0, 2.0, 4.0, 8.0])[1] == [1.0, 1.6, 2.4, 3.6, 5.6, 8.0]


def test_repeated_limits_collapse_and_missing_has_no_class(spark):
    got, breaks = classes(spark, [1.0, 1.0, 1.0, 1.0, 9.0, None])
    assert breaks == [1.0, 2.6, 9.0]
    assert got[-1] is None and got[0] == got[3] == 1 and got[4] == max(c for c in got if c)
    assert classes(spark, [3.0, 3.0])[0] == [1, 1]
    assert classes(spark, [None, None])[0] == [None, None]


def test_choropleth_keeps_areas_with_a_named_boundary(frame):
    table = frame("icb_code string, pct_pharm1st double", ("Q1", 10.0), ("Q2", 20.0), ("Q3", 30.0), ("Q4", 40.0))
    bounds = frame("icb_code string, icb_name string, geometry string", ("Q1", "one", "{}"), ("Q2", "two", "{}"), ("Q3", None, "{}"))
    got = m.icb_choropleth(table, bounds, "pharm1st", classes=2)
    assert rows(got.select("icb_code", "icb_name", "value", "class")) == [("Q1", "one", 10.0, 1), ("Q2", "two", 20.0, 2)]


def test_titles(frame):
    df = frame("d string", ("2023-12-05",), (None,))
    shown = [r[0] for r in df.select(m.map_title("pharm1st", "d")).collect()]
    head = "% of contractors opted in to Pharmacy First service at ICB Level as on "
    assert shown == [head + "2023-12-05", head + "NA"]
    assert df.select(m.point_map_title("contraception", "d")).first()[0].endswith("Contraception Service as on 2023-12-05")


@pytest.fixture(scope="module")
def points(frame):
    opt = frame(
        "ods_code string, opted_in boolean, registered_for_cpcs boolean, opt_in_date date, name string, phone string, "
        "lpc_code string, lpc_name string",
        ("A", True, True, D, "alpha", "1", "L1", "lpc"), ("B", True, False, D, None, "2", "L1", None),
        ("C", True, None, D, None, None, None, None), ("D", False, True, D, None, None, None, None),
        ("A", True, True, D, "again", "1", "L1", "lpc"), ("OFF", True, True, D, None, None, None, None),
    )
    roster = frame(
        "fcode string, postcode string, stp_code string, short_icb_name string, region_name string, trading_name string",
        *[(k, "P1", "Q1", "one", "London", f"shop {k}") for k in "ABCDE"],
        ("F", None, None, None, "London", "shop F"), ("G", "P2", "Q1", None, "London", "shop G"),
        ("H", "P9", "Q1", None, "London", "shop H"),
    )
    postcodes = frame(
        "postcode string, easting double, northing double",
        ("P1", 530000.0, 180000.0), ("P2", None, None), ("P3", 1.0, 1.0), (None, 5.0, 5.0),
    )
    return opt, roster, postcodes


def test_every_roster_provider_becomes_a_point(points):
    got = m.contractor_points(*points, "pharm1st")
    assert rows(got.select("fcode", "opted_in", "name", "lpc", "icb", "easting")) == [
        ("A", True, "again", "L1: lpc", "Q1: one", 530000.0),
        ("A", True, "alpha", "L1: lpc", "Q1: one", 530000.0),
        ("B", True, "shop B", "L1: NA", "Q1: one", 530000.0),
        ("C", True, "shop C", "NA: NA", "Q1: one", 530000.0),
        ("D", False, "shop D", "NA: NA", "Q1: one", 530000.0),
        ("E", False, "shop E", "NA: NA", "Q1: one", 530000.0),
        ("F", False, "shop F", "NA: NA", "NA: NA", 5.0),
        ("G", False, "shop G", "NA: NA", "Q1: NA", None),
        ("H", False, "shop H", "NA: NA", "Q1: NA", None),
    ]


def test_status_colours_layers_and_order(points):
    got = m.contractor_status(m.contractor_points(*points, "pharm1st"), "pharm1st").orderBy(*m.draw_order())
    assert [(r.layer, r.colour, r.fcode) for r in got.collect()] == [
        ("opted_in", "Green", "A"), ("opted_in", "Green", "A"), ("opted_in", "Amber", "B"), ("opted_in", None, "C"),
        ("not_opted_in", "Red", "D"), ("not_opted_in", "Red", "E"),
    ]
    opt, roster, postcodes = points
    two = m.contractor_status(
        m.contractor_points(opt.drop("registered_for_cpcs"), roster, postcodes, "contraception"), "contraception"
    )
    assert {(r.layer, r.colour) for r in two.collect()} == {("opted_in", "Green"), ("not_opted_in", "Red")}
    assert {"lon", "lat"} <= set(m.with_lon_lat(got).columns)


def test_hot_provider_on_the_opt_in_list(spark, points):
    """One provider holding a third of the list keeps every row."""
    opt = spark.range(9000).selectExpr(
        "if(id % 3 = 0, 'A', concat('Z', id)) as ods_code", "true as opted_in", "true as registered_for_cpcs",
        "date'2023-12-05' as opt_in_date", "cast(null as string) as name", "cast(id as string) as phone",
        "'L' as lpc_code", "'l' as lpc_name",
    )
    got = m.contractor_points(opt, points[1], points[2], "pharm1st")
    assert got.where("fcode = 'A'").count() == 3000 and got.count() == 3007
