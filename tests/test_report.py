"""The written report, read back."""

from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from support import SMALL, rows
from muster import labels
from muster.operators import scorecards
from muster.plans import staging as staging_module
from muster.plans.staging import Staging, shared_folder
from muster.sinks import Deck, with_position
from muster.plans.weekly import WeeklyPack, weekly_report
from muster.sources.inputs import SHEETS, Inputs
from muster.sources.readers import SCHEMAS
from muster.sources.sample_tables import AS_OF, SERVICE, SINCE, sample_inputs


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    inputs = sample_inputs(spark, SMALL)
    out = str(tmp_path_factory.mktemp("report"))
    return weekly_report(inputs, out, AS_OF, SINCE, SERVICE), out


def read(spark, path):
    return spark.read.option("header", True).csv(path)


def test_four_sheets_under_a_dated_folder(spark, written):
    folders, out = written
    for sheet in ("National", "Regional", "ICB", "Pharmacy Level"):
        assert folders[sheet] == f"{out}/Pharm1st_OptIn_2024-01-31/{sheet.replace(' ', '_')}"
    national = read(spark, folders["National"])
    assert national.columns[:3] == [
        "Total contractors", "No of contractors opted in Pharm First", "% of contractors opted in Pharm1st",
    ]
    assert national.count() == 1
    assert read(spark, folders["ICB"]).columns[:3] == ["ICB", "Region_Name", "Total contractors"]
    assert "contractors signed up for CPCS but not opted in Pharm1st" in read(spark, folders["Pharmacy Level"]).columns


def test_staged_run_equals_the_lazy_tables(spark, written):
    folders, _ = written
    pack = WeeklyPack(sample_inputs(spark, SMALL), AS_OF, SINCE, SERVICE)
    got = rows(read(spark, folders["ICB"]))
    text = scorecards.icb_display(pack.icb_card)
    want = rows(text.select(*[F.col(c).cast("string") for c in text.columns]))
    assert got == want
    assert read(spark, folders["Pharmacy Level"]).count() == pack.pharmacy_list.count()


def test_sheet_order_is_by_uptake(spark, written):
    shown = [r[4] for r in read(spark, written[0]["ICB"]).collect()]
    values = [float(v) for v in shown if v is not None]
    assert values == sorted(values, reverse=True)


def test_one_folder_per_region(spark, written):
    back = read(spark, written[0]["By region"])
    assert {r[0] for r in back.select("region_folder").distinct().collect()} >= {"London", "Midlands"}


def test_map_layers(spark, written):
    folders, out = written
    assert folders["Map layers"] == f"{out}/opt_in_map_January2024"
    back = spark.read.parquet(folders["Map layers"])
    assert {"lon", "lat", "colour", "title"} <= set(back.columns)
    assert {r.service for r in back.select("service").distinct().collect()} == {"pharm1st", "contraception"}
    box = back.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    assert 49 < box[0] < box[1] < 60 and -9 < box[2] < box[3] < 4


def test_layers_are_drawn_in_one_order_over_all_files(spark, written):
    back = spark.read.parquet(written[0]["Map layers"])
    for (service, layer), points in groupby_layer(back).items():
        assert [p.position for p in points] == list(range(1, len(points) + 1)), (service, layer)
        keys = [(p.draw_order, p.fcode is None, p.fcode or "") for p in points]
        assert keys == sorted(keys)
    legends = {(r.service, r.colour): r.legend for r in back.select("service", "colour", "legend").distinct().collect()}
    assert legends["pharm1st", "Red"] == "Not opted in to PharmFirst yet" and legends.get(("pharm1st", None)) is None


def groupby_layer(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: r.position):
        out.setdefault((row.service, row.layer), []).append(row)
    return out


def test_positions_count_on_over_ranges(spark):
    """A group that is dealt over many ranges gets one gapless order, NULL keys and empty groups included."""
    df = spark.range(0, 5000, 1, 7).selectExpr("if(id % 10 = 0, null, if(id % 3 = 0, 'b', 'a')) as g", "cast(hash(id) as long) as v", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for groups in (["g"], []):
        staging = Staging(spark)
        got = with_position(df, groups, [F.col("v").asc_nulls_last(), F.col("id").asc()], staging, "positions")
        assert got.columns == ["g", "v", "id", "position"]
        assert spark.read.parquet(f"{staging.folder}/positions").select("__range").distinct().count() > 1
        found = {}
        for r in sorted(got.collect(), key=lambda r: (r.v, r.id)):
            found.setdefault(r.g if groups else 0, []).append(r.position)
        assert all(p == list(range(1, len(p) + 1)) for p in found.values()) and sum(map(len, found.values())) == 5000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert with_position(df.limit(0), ["g"], [F.col("v").asc()], Staging(spark), "none").collect() == []


def test_deck_is_resumed_by_table(spark, written, tmp_path):
    folders, out = written
    assert {"Deck trend", "Deck headline", "Deck regional_long", "Deck map_signup_gap"} <= set(folders)
    notes = {r["table"]: r for r in Deck(spark, out, AS_OF, resume=True).manifest().collect()}
    assert notes["headline"].n_rows == 1 and notes["trend"].path == folders["Deck trend"]
    built = []

    def build(n):
        def run():
            built.append(n)
            if n == 2:
                raise RuntimeError("lost")
            return spark.range(n).toDF("x")

        return run

    deck = Deck(spark, str(tmp_path), AS_OF)
    deck.write("one", build(1))
    with pytest.raises(RuntimeError):
        deck.write("two", build(2))
    again = Deck(spark, str(tmp_path), AS_OF, resume=True)
    again.write("one", build(5))
    again.write("two", build(3))
    assert built == [1, 2, 3]
    assert sorted((r["table"], r.n_rows, r["columns"]) for r in again.manifest().collect()) == [("one", 1, ["x"]), ("two", 3, ["x"])]
    Deck(spark, str(tmp_path), AS_OF).write("one", build(4))
    assert built[-1] == 4


def test_repeated_keys_are_refused_on_request(spark, tmp_path):
    with pytest.raises(ValueError, match="repeated keys"):
        weekly_report(sample_inputs(spark, SMALL), str(tmp_path), AS_OF, SINCE, SERVICE, strict_keys=True)


def test_staging_uses_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    staging = Staging(spark)
    kept = staging.keep(spark.range(3).toDF("x"), "numbers")
    assert staging.folder.startswith(folder) and kept.count() == 3
    assert "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("master", "warehouse", "refused"), [
    ("local[4]", "file:/w", False), ("spark://h:7077", "file:/w", True), ("spark://h:7077", "/w/", True), ("yarn", "viewfs://w/w", False),
])
def test_staging_without_a_named_folder(spark, monkeypatch, master, warehouse, refused):
    """The warehouse serves, unless it lies on one machine of a cluster."""

    def schemes(session, folder):
        return folder, SimpleNamespace(getScheme=lambda: folder.partition("://")[0] if "://" in folder else "file")

    monkeypatch.setattr(staging_module, "_files", schemes)
    settings = {"spark.sql.warehouse.dir": warehouse}
    session = SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))
    if refused:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session)
    else:
        assert shared_folder(session) == warehouse.rstrip("/") + "/staging"
    settings["spark.checkpoint.dir"] = "file:/named/"
    assert shared_folder(session) == "file:/named"


def test_contraception_pack(spark):
    pack = WeeklyPack(sample_inputs(spark, SMALL), AS_OF, SINCE, SERVICE).contraception_pack()
    assert set(pack) == {"trend", "headline", "regional", "icb", "map"}
    assert {r.service for r in pack["trend"].collect()} == {"Contraception Opt-In"}
    assert pack["regional"].columns == ["region", "total_contractors", "contraception_opted_in", "pct_contraception"]


def test_run_from_landed_files(spark, tmp_path):
    """Everything read from files as they land gives the same national row as the tables themselves."""
    source = sample_inputs(spark, SMALL)
    tables, sheets = tmp_path / "tables", tmp_path / "sheets"
    for name in ("ref_contractor", "icb_short", "service_registrations", "service_deregistrations"):
        getattr(source, name).write.parquet(str(tables / name))
    source.pharm_list.write.partitionBy("snapshot_month").parquet(str(tables / "pharm_list"))
    names = dict(
        zip(SHEETS, ["Pharmacy First x", "Contraception Service x", "Contraception Reg x", "Contraception Dereg x", "Hypertension x"])
    )
    for name, entry in names.items():
        df = getattr(source, name)
        for f in SCHEMAS[name]:
            if f.type == "date" and f.style == "dmy":
                df = df.withColumn(f.name, F.date_format(f.name, "dd/MM/yyyy"))
        df.withColumnsRenamed({f.name: f.heading or f.name for f in SCHEMAS[name]}).write.csv(str(sheets / entry), header=True)
    source.hundred_hour.withColumnsRenamed({"fcode": "FCode", "hundred_hour": "100 Hour Pharmacy"}).write.csv(
        str(tmp_path / "hundred.csv"), header=True
    )
    source.postcodes.withColumnsRenamed({"postcode": "pcds", "easting": "oseast1m", "northing": "osnrth1m"}).write.csv(
        str(tmp_path / "postcodes.csv"), header=True
    )
    (tmp_path / "areas.geojson").write_text('{"type": "FeatureCollection", "features": []}')
    landed = Inputs.from_landing(
        spark, str(tables), str(sheets), str(tmp_path / "hundred.csv"), str(tmp_path / "postcodes.csv"),
        str(tmp_path / "areas.geojson"),
    )
    args = (AS_OF, SINCE, SERVICE)
    a, b = WeeklyPack(landed, *args), WeeklyPack(source, *args)
    assert a.national.first() == b.national.first()
    assert rows(a.regional) == rows(b.regional)
    assert rows(a.pharmacy_list) == rows(b.pharmacy_list)
    assert a.status(labels.PHARM1ST).count() == b.status(labels.PHARM1ST).count()
    assert date(2024, 1, 31) == AS_OF and a.area_map(labels.PHARM1ST).count() == 0
