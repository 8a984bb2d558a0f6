"""One provider with a third of all rows: oversized join partitions are split, and no row is lost."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from muster.operators import maps, registrations, scorecards
from muster.plans.session import tune

N = 120_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def tight(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield tune(spark)
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def lists(tight):
    hot = "if(id % 3 = 0, 'HOT', concat('P', cast(id as string)))"
    signups = tight.range(0, N, 1, 6).selectExpr(
        f"{hot} as fcode", "date_add(date'2023-12-01', cast(id % 60 as int)) as reg_date", "'Q1' as icb_code",
        "cast(xxhash64(id) as string) as name", "cast(id as string) as phone", "'L' as lpc_code", "'l' as lpc_name",
    )
    roster = tight.range(0, N, 2, 6).selectExpr(
        "if(id = 0, 'HOT', concat('P', cast(id as string))) as fcode", "date'2023-12-01' as snapshot_month",
        "'Q1' as stp", "'Q1' as stp_code", "'one' as short_icb_name", "'London' as region_name",
        "concat('shop ', id) as trading_name", "concat('PC', cast(id % 1000 as string)) as postcode",
        "'No' as hundred_hour",
    )
    return signups, roster


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_join_of_a_hot_list_is_split(lists):
    signups, roster = lists
    plan = final_plan(registrations.bp_registrations(signups, roster))
    assert "skew=true" in plan


def test_points_of_a_hot_list_are_split_and_whole(lists, tight):
    signups, roster = lists
    opt = signups.withColumnsRenamed({"fcode": "ods_code", "reg_date": "opt_in_date"}).withColumn("opted_in", F.lit(True))
    postcodes = tight.range(1000).selectExpr("concat('PC', id) as postcode", "4e5 as easting", "1e5 as northing")
    got = maps.contractor_points(opt, roster, postcodes, "contraception")
    plan = final_plan(got)
    assert "skew=true" in plan
    codes = signups.select("fcode").join(roster.select("fcode"), "fcode").count()
    unmatched = roster.join(signups, "fcode", "left_anti").count()
    assert got.count() == codes + unmatched


def test_anti_join_of_a_hot_list_is_split(lists):
    signups, _ = lists
    opt = signups.limit(0).withColumnsRenamed({"fcode": "ods_code", "reg_date": "opt_in_date"}).withColumn("opted_in", F.lit(True))
    dereg = signups.where("fcode <> 'HOT'").selectExpr("fcode as ods_code", "reg_date as service_end")
    got = registrations.contraception_opt_ins(opt, signups, dereg, date(2023, 12, 1), date(2024, 6, 1))
    assert "skew=true" in final_plan(got)
    assert got.count() == N // 3


def test_counts_move_one_row_per_provider(lists):
    """The hot provider reaches the second shuffle as a handful of rows, so nothing is skewed there."""
    signups, roster = lists
    opt = signups.withColumnsRenamed({"fcode": "ods_code", "reg_date": "opt_in_date"}).withColumn("opted_in", F.lit(True))
    facts = scorecards.service_facts(opt, opt, signups, roster, date(2023, 12, 1), ["icb_code"])
    assert facts.where("fcode = 'HOT'").count() == 4
    assert scorecards.national_from_facts(scorecards.refold(facts)).first().pharm1st_opted_in == N - N // 3 + 1
