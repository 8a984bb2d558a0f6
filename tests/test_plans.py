"""Plan shapes every registered query must keep, checked with broadcasts off, as for tables too large for them."""

import re

import pytest

from support import SMALL
from muster.operators.joins import na_join
from muster.plans import registered
from muster.plans.session import BROADCAST_BYTES, tune
from oracle import sql

LAZY = [q for q in registered.queries() if not q.startswith(("landed_", "report_", "deck_", "order_", "stored_"))]


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_product_no_python_no_broadcast_hint(no_broadcast, name):
    text = plan(registered.queries()[name](no_broadcast, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "BroadcastExchange"):
        assert bad not in text, bad


def test_every_query_has_sql():
    assert set(registered.queries()) == set(sql.statements())


def test_scans_are_pruned_and_filtered(no_broadcast):
    text = plan(registered.queries()["weekly_trend"](no_broadcast, SMALL))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(event_type,signup\)", text)
    scans = set(re.findall(r"FileScan parquet \[([^]]*)\]", text))
    assert scans and not any("o_totalprice" in s or "c_name" in s for s in scans)


def test_latest_report_date_is_pushed_to_the_scan(no_broadcast):
    text = plan(registered.queries()["latest_registrations"](no_broadcast, SMALL))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(o_orderpriority,1-URGENT\)", text)


def test_roster_membership_reuses_the_roster_partitioning(no_broadcast):
    """The roster joins already place providers; folding them to distinct keys needs no further shuffle."""
    text = plan(registered.queries()["signup_valid_count"](no_broadcast, SMALL))
    folds = len(re.findall(r"HashAggregate\(keys=\[__right_fcode_0", text))
    shuffles = len(re.findall(r"Exchange hashpartitioning\(__right_fcode_0", text))
    # Two membership joins per sign-up list, two aggregates each: only the de-registrations are shuffled.
    assert folds and folds == 4 * shuffles


def test_scorecards_shuffle_sign_ups_twice_at_most(no_broadcast):
    """Fold by service and provider, then by provider, then the small count by area."""
    text = plan(registered.queries()["icb_scorecard"](no_broadcast, SMALL))
    above = text[: text.index("Union")]
    assert above.count("Exchange hashpartitioning(service") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(fcode#\d+, 4\)", above)) == 1


@pytest.mark.parametrize("name", ["narrative", "region_icb_detail"])
def test_every_list_is_scanned_once(no_broadcast, name):
    """The headline and the area detail take counts, dates and reconciliation from one pass over each list."""
    text = plan(registered.queries()[name](no_broadcast, SMALL))
    for kind in ("signup", "purchase", "click", "error", "view"):
        assert len(re.findall(rf"PushedFilters: \[[^]]*EqualTo\(event_type,{kind}\)", text)) == 1, kind


def test_area_detail_shuffles_its_facts_twice(no_broadcast):
    """Fold by provider and area, then by provider; the second fold by provider and area needs no shuffle."""
    text = plan(registered.queries()["region_icb_detail"](no_broadcast, SMALL))
    above = text[: text.index("Union")]
    assert len(re.findall(r"Exchange hashpartitioning\(fcode#\d+, icb_code#\d+, 4\)", above)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(fcode#\d+, 4\)", above)) == 1


def test_a_list_stored_by_month_reads_one_month(no_broadcast):
    text = plan(registered.queries()["stored_pharm_list"](no_broadcast, SMALL))
    assert re.search(r"PartitionFilters: \[[^]]*snapshot_month#\d+ = Subquery", text)


def _thresholds(spark, *values):
    """What ``tune`` makes of the two broadcast thresholds; the session's own come back."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    try:
        for key, value in zip(keys, values, strict=True):
            spark.conf.set(key, value) if value else spark.conf.unset(key)
        tune(spark)
        return [spark.conf.get(k, None) for k in keys]
    finally:
        for key, value in zip(keys, old, strict=True):
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_tuning_only_lowers_the_broadcast_thresholds(spark):
    bound = str(BROADCAST_BYTES)
    assert _thresholds(spark, None, None) == [bound, None]
    assert _thresholds(spark, "10MB", None) == [bound, None]
    assert _thresholds(spark, "10485760b", "1g") == [bound, bound]
    assert _thresholds(spark, "-1", "-1") == ["-1", "-1"]
    assert _thresholds(spark, "64k", "4096") == ["64k", "4096"]


def test_a_register_of_many_providers_does_not_pass_through_the_driver(spark, tmp_path):
    """Its file is far under Spark's own threshold, as its columns compress well; its rows are not."""
    spark = spark.newSession()  # with Spark's own settings
    path, n = f"{tmp_path}/register", 200_000
    spark.range(n).selectExpr("concat('F', id) as fcode", "repeat('x', 200) as area").coalesce(1).write.parquet(path)
    assert sum(f.stat().st_size for f in (tmp_path / "register").glob("*.parquet")) < 4 << 20
    register = tune(spark).read.parquet(path)
    listed = register.select("fcode")
    register.limit(3).selectExpr("fcode", "1 as seen").write.parquet(f"{path}_few")
    few = spark.read.parquet(f"{path}_few")
    for joined in (na_join(listed, register, "fcode", "left"), na_join(listed, register.select("fcode"), "fcode", "left_semi")):
        assert "BroadcastExchange" not in plan(joined)
    assert "BroadcastExchange" in plan(na_join(listed, few, "fcode", "left"))
