import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from support import rows
from muster.sources import readers
from muster.sources.inputs import Inputs, Source
from muster.sources.sample_tables import _code

HEAD = "ODS.Code,Opted.In,Opt.In.Date,Registered.for.CPCS,ICB.Code,Name,F.code.Phone.Number,LPC.Code,LPC.Name,Extra\n"


def write(folder, name, text):
    (folder / name).write_text(text)


def test_sheet_is_found_typed_and_cut_to_its_columns(spark, tmp_path):
    write(tmp_path, "PHARMACY FIRST opt-in 5 Dec.csv", HEAD + "A,TRUE,1/12/2023,,Q1,n,01,L,l,x\nB,FALSE,soon,true,,,,,,\n,maybe,05/12/2023 10:00,,,,,,,\n")
    write(tmp_path, "Contraception Service.csv", HEAD)
    with pytest.raises(ValueError, match=r"'opted_in': 1, 'opt_in_date': 1"):
        readers.read_landed(spark, str(tmp_path), "pharm1st")
    got = readers.read_landed(spark, str(tmp_path), "pharm1st", tolerate={"opted_in": 1, "opt_in_date": 1})
    assert got.dtypes[:4] == [
        ("ods_code", "string"), ("opted_in", "boolean"), ("opt_in_date", "date"), ("registered_for_cpcs", "boolean"),
    ]
    assert rows(got.select("ods_code", "opted_in", "opt_in_date", "registered_for_cpcs", "icb_code")) == [
        ("A", True, date(2023, 12, 1), None, "Q1"),
        ("B", False, None, True, None),
        (None, None, date(2023, 12, 5), None, None),
    ]


def test_quoted_line_breaks_make_no_rows(spark, tmp_path):
    write(tmp_path, "bp.csv", 'F.Code,Date,ICB.Code,Note\nA,1/12/2023,Q1,"two\nlines"\nB,2/12/2023,"Q\n2","say ""hi"""\n')
    got = readers.read_sheet(spark, str(tmp_path / "bp.csv"), "bp_reg")
    assert rows(got) == [("A", date(2023, 12, 1), "Q1"), ("B", date(2023, 12, 2), "Q\n2")]
    with pytest.raises(ValueError, match="'broken rows': [1-4]"):
        readers.read_sheet(spark, str(tmp_path / "bp.csv"), "bp_reg", multi_line=False)


def test_short_rows_are_counted(spark, tmp_path):
    write(tmp_path, "bp.csv", "F.Code,Date,ICB.Code\nA,1/12/2023,Q1\nB\n")
    with pytest.raises(ValueError, match="'broken rows': 1"):
        readers.read_sheet(spark, str(tmp_path / "bp.csv"), "bp_reg")
    got = readers.read_sheet(spark, str(tmp_path / "bp.csv"), "bp_reg", tolerate={"broken rows": 1})
    assert rows(got) == [("A", date(2023, 12, 1), "Q1")]


def test_long_keys_keep_their_digits(spark):
    codes = spark.sql("select explode(array(7L, 1234567890123L, 1234567890124L)) as k").selectExpr(f"{_code('F', 'k')} as c")
    assert rows(codes) == [("F000000000007",), ("F1234567890123",), ("F1234567890124",)]


def test_exactly_one_file_must_match(spark, tmp_path):
    write(tmp_path, "contraception re a.csv", "x\n")
    write(tmp_path, "Contraception Reg b.csv", "x\n")
    with pytest.raises(ValueError, match="expected one"):
        readers.find_one(spark, str(tmp_path), "contraception re")
    with pytest.raises(ValueError, match="none"):
        readers.find_one(spark, str(tmp_path), "hypertension")


def test_a_folder_of_part_files_is_one_entry(spark, tmp_path):
    spark.range(10).repartition(3).write.csv(str(tmp_path / "Hypertension 1"), header=True)
    for folder in (str(tmp_path), f"{tmp_path}/", f"file://{tmp_path}", f"file:{tmp_path}"):
        found = readers.find_one(spark, folder, "hypertension")
        assert found == f"{folder.rstrip('/')}/Hypertension 1"
        assert spark.read.csv(found, header=True).count() == 10


def test_only_needed_columns_are_parsed(spark, tmp_path):
    write(tmp_path, "d.csv", "ctry,pcds,oseast1m,osnrth1m,usertype\nE,AB1 2CD,400000,100000,0\nE,ZZ1 1ZZ,,,1\n")
    got = readers.read_postcodes(spark, str(tmp_path / "d.csv"))
    assert rows(got) == [("AB1 2CD", 400000.0, 100000.0), ("ZZ1 1ZZ", None, None)]
    plan = got.select("postcode")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ReadSchema: struct<postcode:string>" in plan


def test_positional_input_must_have_six_columns(spark, tmp_path):
    write(tmp_path, "contraception de.csv", "a,b,c,d,e,f\nA,2023-12-01,2023-12-02,2023-12-31,Q1,x\n")
    got = readers.read_landed(spark, str(tmp_path), "contraception_dereg")
    assert got.columns == ["ods_code", "date_dereg", "date_notice", "service_end", "icb", "area"]
    assert got.first().service_end == date(2023, 12, 31)
    write(tmp_path, "five.csv", "a,b,c,d,e\n1,2,3,4,5\n")
    with pytest.raises(ValueError, match="expected 6 columns, found 5"):
        readers.read_sheet(spark, str(tmp_path / "five.csv"), "contraception_dereg")


def test_missing_column_fails_at_once(spark, frame):
    with pytest.raises(ValueError, match=r"missing columns \['ICB.Code'\]"):
        readers.conform(frame("`F.Code` string, `Date` string", ("A", "1/1/2024")), "bp_reg")


def test_typed_dates_pass_through(frame):
    got = readers.conform(frame("fcode string, reg_date date, icb_code string", ("A", date(2024, 1, 1), "Q")), "bp_reg")
    assert got.first().reg_date == date(2024, 1, 1)


def test_parquet_and_catalog_tables(spark, tmp_path, frame):
    df = frame("icb_code string, short_icb_name string, other int", ("Q1", "one", 1))
    df.write.parquet(str(tmp_path / "icb_short"))
    df.createOrReplaceTempView("icb_short")
    for got in (readers.read_table(spark, "icb_short", str(tmp_path / "icb_short")), readers.read_table(spark, "icb_short")):
        assert rows(got) == [("Q1", "one")]
    df.write.parquet(str(tmp_path / "sheet.parquet"))
    assert rows(readers.read_sheet(spark, str(tmp_path / "sheet.parquet"), "icb_short")) == [("Q1", "one")]


def feature(code, name, shape):
    return {"type": "Feature", "properties": {"icb_code": code, "icb_name": name, "area": 1}, "geometry": shape}


def test_boundaries_keep_any_shape_as_text(spark, tmp_path):
    shapes = [
        {"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [0, 1]]]},
        {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 1], [0, 1]]]]},
    ]
    features = [feature("Q1", "one", shapes[0]), feature("Q2", "two", shapes[1])]
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "l.geojsonl").write_text("\n".join(map(json.dumps, features)))
    whole = readers.read_boundaries(spark, str(tmp_path / "c.geojson"))
    lines = readers.read_boundaries(spark, str(tmp_path / "l.geojsonl"), lines=True)
    for got in (whole, lines):
        assert rows(got.select("icb_code", "icb_name")) == [("Q1", "one"), ("Q2", "two")]
        assert [json.loads(r.geometry) for r in got.orderBy("icb_code").collect()] == shapes


def test_inputs_open_on_first_use(spark, frame):
    opened = []

    def open_roster():
        opened.append(1)
        return frame("a int", (1,))

    inputs = Inputs(pharm_list=open_roster, icb_short=frame("b int", (2,)))
    assert opened == [] and inputs.pharm_list.first().a == 1 and inputs.pharm_list is inputs.pharm_list
    assert opened == [1] and inputs.icb_short.first().b == 2
    with pytest.raises(AttributeError, match="not given"):
        inputs.postcodes
    with pytest.raises(ValueError, match="unknown"):
        Inputs(nonsense=open_roster)


def test_landed_boundaries_are_split_over_tasks(spark, tmp_path):
    """One feature per line, or Parquet, through ``from_landing``: several tasks read one file, and the rows are those
    of the collection."""
    shapes = [{"type": "Polygon", "coordinates": [[[i, 0], [1, i], [0, 1]]]} for i in range(400)]
    features = [feature(f"Q{i}", f"area {i}", shape) for i, shape in enumerate(shapes)]
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    (tmp_path / "l.geojsonl").write_text("\n".join(map(json.dumps, features)))

    def landed(path, **options):
        paths = dict.fromkeys(("tables", "sheets", "hundred_hour", "postcodes"), str(tmp_path / "absent"))
        return Inputs.from_landing(spark, **paths, boundaries=str(path), **options).boundaries

    whole = landed(tmp_path / "c.geojson")
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = landed(tmp_path / "l.geojsonl", boundary_lines=True)
        lines.coalesce(1).write.option("parquet.block.size", 4096).option("compression", "none").parquet(str(tmp_path / "p.parquet"))
        table = landed(tmp_path / "p.parquet")
        tasks = [df.groupBy(F.spark_partition_id()).count().count() for df in (whole, lines, table)]
        assert min(tasks) > 1
        want = [(f"Q{i}", f"area {i}", shape) for i, shape in enumerate(shapes)]
        for got in (whole, lines, table):
            assert got.columns == ["icb_code", "icb_name", "geometry"]
            found = sorted(((r.icb_code, r.icb_name, json.loads(r.geometry)) for r in got.collect()), key=lambda r: int(r[0][1:]))
            assert found == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)


def test_a_collection_is_cut_into_its_features(spark, tmp_path):
    """Whatever the spelling between the keys, and with text inside values that looks like a feature."""
    shape = {"type": "Point", "coordinates": [1, 2]}
    tricky = [feature("Q1", 'say {"type": "Feature", "x": 1}', shape), feature(None, None, shape), feature("Q3", "ü, }]", shape)]
    styles = {"a": {}, "b": {"indent": 2}, "c": {"separators": (",", ":")}}
    for name, style in styles.items():
        path = tmp_path / f"{name}.geojson"
        path.write_text(json.dumps({"type": "FeatureCollection", "name": "n", "features": tricky, "bbox": [0, 1]}, **style))
        got = sorted(((r.icb_code or "", r.icb_name, json.loads(r.geometry)) for r in readers.read_boundaries(spark, str(path)).collect()), key=str)
        assert got == sorted([("Q1", tricky[0]["properties"]["icb_name"], shape), ("", None, shape), ("Q3", "ü, }]", shape)], key=str), name


def test_a_collection_that_cannot_be_cut_is_refused_or_read_whole(spark, tmp_path):
    shape = {"type": "Point", "coordinates": [1, 2]}
    other = {"properties": {"icb_code": "Q2", "icb_name": "two"}, "type": "Feature", "geometry": shape}
    (tmp_path / "whole.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [other, other]}))
    assert readers.read_boundaries(spark, str(tmp_path / "whole.geojson")).count() == 2
    broken = '{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"icb_code": "Q1"'
    (tmp_path / "broken.geojson").write_text(broken)
    with pytest.raises(Exception, match="not a feature"):
        readers.read_boundaries(spark, str(tmp_path / "broken.geojson")).collect()


def test_directory_rows_are_counted_where_they_are_read(spark, tmp_path):
    write(tmp_path, "d.csv", 'pcds,oseast1m,osnrth1m,note\nAB1,400000,100000,x\nAB2,west,1,x\nAB3,4,5\nAB4,1,2,"two\nlines"\n')
    with pytest.raises(ValueError, match=r"postcodes: unreadable in .*'easting': 1, 'broken rows': [23]"):
        readers.read_postcodes(spark, str(tmp_path / "d.csv"))
    got = readers.read_postcodes(spark, str(tmp_path / "d.csv"), tolerate={"easting": 1, "broken rows": 3})
    assert {r.postcode for r in got.collect()} >= {"AB1", "AB2"} and got.where("postcode = 'AB3'").isEmpty()


def test_a_sheet_is_read_once(spark, tmp_path):
    """What is returned are the typed columns written by the pass that checked the text."""
    write(tmp_path, "bp.csv", "F.Code,Date,ICB.Code\nA,1/12/2023,Q1\n")
    got = readers.read_sheet(spark, str(tmp_path / "bp.csv"), "bp_reg")
    (tmp_path / "bp.csv").write_text("F.Code,Date,ICB.Code\n")
    assert rows(got) == [("A", date(2023, 12, 1), "Q1")]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in text and "FileScan csv" not in text


def test_inputs_from_any_mix_of_places(spark, tmp_path, frame):
    frame("icb_code string, short_icb_name string", ("Q1", "one")).createOrReplaceTempView("areas_of_today")
    frame("fcode string, hundred_hour string", ("A", "Yes")).write.parquet(str(tmp_path / "hundred.parquet"))
    write(tmp_path, "Hypertension 1.csv", "F.Code,Date,ICB.Code\nA,1/12/2023,Q1\n")
    inputs = Inputs.from_sources(
        spark,
        icb_short=Source("table", "areas_of_today"),
        hundred_hour=Source("sheet", str(tmp_path / "hundred.parquet")),
        bp_reg=Source("landed", str(tmp_path), {"tolerate": {"reg_date": 1}}),
        pharm1st=frame("a int", (1,)),
        boundaries=Source("geojson", str(tmp_path / "absent.geojson")),
    )
    assert rows(inputs.icb_short) == [("Q1", "one")] and rows(inputs.hundred_hour) == [("A", "Yes")]
    assert rows(inputs.bp_reg) == [("A", date(2023, 12, 1), "Q1")] and inputs.pharm1st.first().a == 1
    with pytest.raises(ValueError, match="unknown kind"):
        Source("fax", "x")
