"""Expected values published with the fixture views of FIXTURES.md, computed by the operators."""

import os
import re

import pytest
from pyspark.sql import functions as F

from support import MEDIUM, ROOT, SMALL, rows
from muster.operators import registrations, roster, scorecards
from muster.plans.weekly import WeeklyPack
from muster.sources.inputs import Inputs
from muster.sources.sample_tables import AS_OF, SERVICE, SINCE
from oracle.compare import TABLES


def build(spark, sf_dir):
    for t in TABLES[:4] + ["orders", "events"]:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    with open(os.path.join(ROOT, "FIXTURES.md")) as f:
        block = re.search(r"```sql\n(.*?)```", f.read(), re.S).group(1)
    for statement in filter(str.strip, block.split(";")):
        spark.sql(statement)
    view = lambda name: spark.table(f"fx_{name}")
    none = F.lit(None).cast("string")
    contact = dict.fromkeys(("name", "phone", "lpc_code", "lpc_name"), none)
    inputs = Inputs(
        ref_contractor=view("ref_contractor"),
        pharm_list=view("pharm_list").withColumns({"icb_name": none, "hwb": none, "organisation_name": none}),
        hundred_hour=view("hundred_hour"),
        icb_short=view("icb_short"),
        pharm1st=view("pharm1st").withColumns(contact),
        contraception_opt=view("oc_opt").withColumns(contact),
        contraception_reg=view("oc_reg").withColumns(contact),
        contraception_dereg=view("oc_dereg"),
        bp_reg=view("bp_reg"),
        service_registrations=view("service_registrations"),
        service_deregistrations=view("service_deregistrations"),
        postcodes=view("coords"),
        boundaries=view("boundaries").withColumn("geometry", none),
    )
    return WeeklyPack(inputs, AS_OF, SINCE, SERVICE)


@pytest.fixture(scope="module", params=[SMALL, MEDIUM])
def case(request, spark):
    return request.param == SMALL, build(spark, request.param)


def pick(small, a, b):
    return a if small else b


def test_roster(case):
    small, p = case
    r = p.roster
    got = r.agg(F.count("*"), F.count_distinct("fcode"), F.count_distinct("stp"), F.count_if(F.expr("hundred_hour = 'Yes'")),
                F.count_if(F.expr("region_name = 'Region Unknown'")), F.count_if(F.expr("icb is null")))
    assert tuple(got.first()) == pick(small, (62, 62, 23, 15, 1, 2), (574, 574, 24, 147, 29, 19))
    assert roster.total_contractors(r).first()[0] == pick(small, 62, 574)


def test_signups(case):
    small, p = case
    got = p.signups.agg(F.count("*"), F.count_distinct("fcode")).first()
    assert tuple(got) == pick(small, (11, 10), (163, 146))
    assert p.signup_count.first().valid_signups == pick(small, 10, 146)


def test_reconcile(case):
    small, p = case
    got = p.reconciled_rows.agg(F.count_if(F.expr("icb_code is null")), F.count_if(F.expr("mismatch is null"))).first()
    assert tuple(got) == pick(small, (2, 21), (44, 204))


def test_areas_without_100_hour(case):
    small, p = case
    every, kept = p.icb_card_for(keep_all_areas=True), p.icb_card
    assert every.count() - kept.count() == pick(small, 12, 0)
    if not small:
        assert kept.where("pct_pharm1st > 100").count() == 23


def test_contraception_and_bp(case):
    small, p = case
    i = p.inputs
    assert p.contraception.count() - i.contraception_opt.count() == pick(small, 91, 916)
    bp = registrations.bp_metrics(p.bp, SINCE).first()
    assert (bp.total, bp.invalid, bp.new_registrations) == pick(small, (106, 63, 24), (1112, 679, 304))


def test_points_and_boundaries(case):
    small, p = case
    codes = p.points("pharm1st").where("easting is null").select("fcode").distinct().count()
    assert codes == pick(small, 4, 35)
    areas = p.roster.select("stp").distinct()
    unmapped = areas.join(p.inputs.boundaries, F.col("stp").eqNullSafe(F.col("icb_code")), "left_anti")
    assert unmapped.count() == 1


def test_weekly(case):
    small, p = case
    got = rows(p.trend.where("service = 'Pharmacy First Opt-In'").select("week", "optin"))
    assert [n for _, n in got] == pick(small, [37, 37, 34, 34, 13, 8], [303, 369, 371, 356, 170, 59])
    assert str(got[0][0]) == "2023-12-31" and got[-1][0] is None


def test_regions_add_up(case):
    _, p = case
    sums = ["total_contractors", "pharm1st_opted_in", "bp_new", "total_100_hour"]
    regional = p.regional.agg(*[F.sum(c) for c in sums]).first()
    areas = p.icb_card.agg(*[F.sum(c) for c in sums]).first()
    assert tuple(regional) == tuple(areas)
    assert scorecards.headline_values(p.national).first().pharm1st_opted_in == p.national.first().pharm1st_opted_in
