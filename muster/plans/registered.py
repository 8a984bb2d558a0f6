"""Every query of the library, over the registers derived from the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster import labels
from muster.functions import date_text, month_stamp, parse_date, week_floor
from muster.operators import maps, registrations, roster, scorecards, trends
from muster.operators.joins import first_by, na_join
from muster.plans.session import tune
from muster.plans.staging import Staging
from muster.plans.weekly import WeeklyPack, weekly_report
from muster.sinks import with_position
from muster.sinks.report import HEADINGS
from muster.sources import readers
from muster.sources.inputs import LOOKUPS, SHEETS, STORED, Inputs, Source
from muster.sources.sample_tables import AS_OF, LONDON, SERVICE, SINCE, sample_inputs

Query = Callable[[SparkSession, str], DataFrame]


def _pack(spark: SparkSession, sf_dir: str) -> WeeklyPack:
    return WeeklyPack(sample_inputs(tune(spark), sf_dir), AS_OF, SINCE, SERVICE)


def _over(build: Callable[[WeeklyPack], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_pack(spark, sf_dir))


def _numbered_choropleth(pack: WeeklyPack, measure: str) -> DataFrame:
    """Breaks as text, so that the table is flat."""
    return _broken_out(pack.area_map(measure, na_rm=True))


def _broken_out(table: DataFrame) -> DataFrame:
    if "breaks" not in table.columns:
        return table
    return table.withColumn("breaks", F.array_join(F.transform("breaks", lambda b: F.format_string("%.3f", b)), ","))


def _text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in several spellings and read back."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    dmy = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "d/M/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" 00:00")))
        .otherwise(F.concat(F.lit("not a date "), F.date_format(day, "dd/MM/yyyy")))
    )
    return orders.select(
        key,
        parse_date(dmy, "dmy").alias("from_dmy"),
        parse_date(F.date_format(day, "yyyy-MM-dd HH:mm"), "ymd").alias("from_ymd"),
    )


def _weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per Sunday week."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    week = week_floor(F.col("o_orderdate").cast("date"))
    return orders.groupBy(week.alias("week")).agg(
        F.count(F.lit(1)).alias("n"), date_text(F.max(F.col("o_orderdate").cast("date"))).alias("last_day"),
        month_stamp(week).alias("month_stamp"),
    )


def _first_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of every customer, whole row kept."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    kept = first_by(orders, ["o_custkey"], [F.col("o_orderdate").cast("date"), "o_orderkey"])
    return kept.select("o_custkey", "o_orderkey", "o_orderpriority")


def _typed_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders have a listed customer, the numbers being long on one side and decimal on the other."""
    orders = tune(spark).read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey", "case when o_orderkey % 10 <> 0 then o_custkey end as custkey"
    )
    listed = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "cast(case when c_custkey % 7 <> 0 then c_custkey end as decimal(20, 2)) as listed"
    ).where("listed % 2 = 0 or listed is null")
    keys = [("custkey", "listed")]
    found, other = (na_join(orders, listed, keys, how) for how in ("left_semi", "left_anti"))
    return found.withColumn("in_list", F.lit(True)).unionByName(other.withColumn("in_list", F.lit(False)))


def _broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet with line breaks and quotes inside its texts."""
    path = f"{Staging(spark).folder}/sheet"
    source = _pack(spark, sf_dir).inputs.contraception_opt
    source = source.withColumn("name", F.concat("name", F.lit('\nof "'), "icb_code", F.lit('",\n')))
    headings = {f.name: f.heading for f in readers.SCHEMAS["contraception_opt"]}
    written = source.withColumnsRenamed(headings).write.option("header", True).option("escape", '"')
    written.option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_sheet(spark, path, "contraception_opt")


def _landed(name: str, headings: dict[str, str], as_text: Callable[[DataFrame], DataFrame], entry: str) -> Query:
    """An input written as a sheet would land, found by its leading name and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pack = _pack(spark, sf_dir)
        folder = Staging(spark).folder
        source = as_text(getattr(pack.inputs, name)).withColumnsRenamed(headings)
        source.write.option("header", True).csv(f"{folder}/{entry}")
        return readers.read_landed(spark, folder, name)

    return run


def _dmy(column: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn(column, F.date_format(column, "d/M/yyyy"))


def _hundred_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Staging(spark).folder}/hundred"
    headings = {f.name: f.heading for f in readers.SCHEMAS["hundred_hour"]}
    _pack(spark, sf_dir).inputs.hundred_hour.withColumnsRenamed(headings).write.option("header", True).csv(path)
    return readers.read_sheet(spark, path, "hundred_hour")


def _landed_postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Staging(spark).folder}/directory.csv"
    wide = _pack(spark, sf_dir).inputs.postcodes.select(
        F.lit("E").alias("ctry"),
        F.col("postcode").alias("pcds"),
        F.col("easting").cast("long").alias("oseast1m"),
        F.col("northing").cast("long").alias("osnrth1m"),
        F.lit(1).alias("usertype"),
    )
    wide.write.option("header", True).csv(path)
    return readers.read_postcodes(spark, path)


def _feature() -> Column:
    """An area as the text of a GeoJSON feature."""
    named = F.to_json(F.struct("icb_code", "icb_name"), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"type": "Feature", "properties": '), named, F.lit(', "geometry": '), "geometry", F.lit("}"))


def _landed_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Staging(spark).folder}/areas.geojsonl"
    _pack(spark, sf_dir).inputs.boundaries.select(_feature()).write.text(path)
    return readers.read_boundaries(spark, path, lines=True)


def _landed_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boundaries as one feature collection, several lines long, cut into its features."""
    path = f"{Staging(spark).folder}/areas.geojson"
    features = _pack(spark, sf_dir).inputs.boundaries.agg(F.array_join(F.collect_list(_feature()), ",\n").alias("all"))
    whole = F.concat(F.lit('{"type": "FeatureCollection", "name": "areas",\n"features": [\n'), "all", F.lit("\n]}\n"))
    features.select(whole).write.text(path)
    return readers.read_boundaries(spark, path)


def _stored(name: str, kind: str, *split: str) -> Callable[[SparkSession, str], WeeklyPack]:
    """A report run whose input ``name`` lies in storage, the others being frames."""

    def run(spark: SparkSession, sf_dir: str) -> WeeklyPack:
        folder, inputs = Staging(spark).folder, sample_inputs(tune(spark), sf_dir)
        getattr(inputs, name).write.partitionBy(*split).parquet(f"{folder}/{name}")
        place = f"{folder}/{name}"
        if kind == "table":
            place = f"stored_{name}"
            spark.read.parquet(f"{folder}/{name}").createOrReplaceTempView(place)
        rest = {n: getattr(inputs, n) for n in (*STORED, *SHEETS, *LOOKUPS) if n != name}
        return WeeklyPack(Inputs.from_sources(spark, **rest, **{name: Source(kind, place)}), AS_OF, SINCE, SERVICE)

    return run


def _stored_pharm_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster.latest_snapshot(_stored("pharm_list", "parquet", "snapshot_month")(spark, sf_dir).inputs.pharm_list)


def _ordered(build: Callable[[WeeklyPack], DataFrame], groups: list[str], order: Callable[[], list], *columns: str) -> Query:
    """A table's stored order: each row's position."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return with_position(build(_pack(spark, sf_dir)), groups, order(), Staging(spark), "ordered").select("position", *columns)

    return run


def _uptake(*ties: str) -> Callable[[], list]:
    return lambda: [F.col("pct_pharm1st").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]


#: Folders of the report by application and tables: one run serves every query that reads it back.
_REPORTS: dict[tuple[str, str], dict[str, str]] = {}


def _report(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    run = (spark.sparkContext.applicationId, sf_dir)
    if run not in _REPORTS:
        inputs = sample_inputs(tune(spark), sf_dir)
        _REPORTS[run] = weekly_report(inputs, Staging(spark).folder + "/out", AS_OF, SINCE, SERVICE)
    return _REPORTS[run]


def _written(table: str, shape: Callable[[WeeklyPack], DataFrame]) -> Query:
    """One table of the written report read back whole, its headings turned into the names of ``shape``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        back = spark.read.option("header", True).csv(_report(spark, sf_dir)[table])
        headings = HEADINGS.get(table, labels.DISPLAY) | ({"region_name": "region_folder"} if table == "By region" else {})
        kinds = {f.name: f.dataType for f in shape(_pack(spark, sf_dir)).schema}
        return back.select(*[F.col(f"`{headings.get(n, n)}`").cast(kind).alias(n) for n, kind in kinds.items()])

    return run


def _deck(name: str) -> Query:
    """A table of the deck, found by the manifest and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _report(spark, sf_dir)[f"Deck {name}"]
        return _broken_out(spark.read.parquet(path))

    return run


def _folder(path: Column, out: Column) -> Column:
    return F.substring(path, F.length(out) + 2, F.lit(1 << 20))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deck's manifest: every table with its folder and rows."""
    trend = _report(spark, sf_dir)["Deck trend"]
    out = trend.removesuffix("/trend").rpartition("/")[0]
    notes = spark.read.schema("path string, n_rows bigint, `table` string").json(f"{trend.removesuffix('/trend')}/manifest")
    return notes.select("table", _folder(F.col("path"), F.lit(out)).alias("folder"), "n_rows")


def _folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dated names of the sheets, the region folder and the map layers, with the rows found under each."""
    written = _report(spark, sf_dir)
    out = written["By region"].rpartition("/")[0]
    parts = []
    for name in (*labels.SHEETS, "By region", "Map layers"):
        back = spark.read.parquet(written[name]) if name == "Map layers" else spark.read.option("header", True).csv(written[name])
        counted = back.agg(F.count(F.lit(1)).alias("n_rows"))
        parts.append(counted.select(F.lit(name).alias("name"), _folder(F.lit(written[name]), F.lit(out)).alias("folder"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


def _written_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_report(spark, sf_dir)["Map layers"]).select(
        "service", "layer", "colour", "draw_order", "fcode", "name", "phone", "lpc", "icb", "region_name", "opt_in_date",
        "postcode", "title", "legend", "position", F.round("lon", 5).alias("lon"), F.round("lat", 5).alias("lat"),
    )


def queries() -> dict[str, Query]:
    p1, oc, gap = labels.PHARM1ST, labels.CONTRACEPTION, labels.SIGNUP_GAP
    out: dict[str, Query] = {
        # Registers
        "latest_contractor": _over(lambda p: p.contractor),
        "roster_latest": _over(lambda p: p.roster),
        "total_contractors": _over(lambda p: roster.total_contractors(p.roster)),
        "total_100_hour": _over(lambda p: roster.total_100_hour(p.roster)),
        "icb_totals": _over(lambda p: p.icb_totals),
        "icb_totals_100_hour": _over(lambda p: roster.icb_totals_100_hour(p.roster)),
        "roster_date": _over(lambda p: roster.roster_date(p.roster)),
        # Sign-up lists
        "active_deregistrations": _over(
            lambda p: registrations.active_deregistrations(p.inputs.contraception_dereg, AS_OF)
        ),
        "contraception_opt_ins": _over(lambda p: p.contraception),
        "bp_registrations": _over(lambda p: p.bp),
        "bp_metrics": _over(lambda p: p.bp_figures),
        "latest_registrations": _over(
            lambda p: registrations.latest_registrations(p.inputs.service_registrations, SERVICE)
        ),
        "latest_deregistrations": _over(
            lambda p: registrations.latest_deregistrations(p.inputs.service_deregistrations, SERVICE)
        ),
        "signup_valid": _over(lambda p: p.signups),
        "last_dates": _over(lambda p: p.last_dates()),
        "last_dates_na_rm": _over(lambda p: p.last_dates(na_rm=True)),
        # Reconciliation
        "reconcile": _over(lambda p: p.reconciled_rows),
        "reconcile_evidence": _over(lambda p: p.evidence.distinct()),
        "reconcile_factors": _over(lambda p: p.reconcile_factors),
        "reconcile_counts": _over(lambda p: p.reconcile_counts),
        "signup_valid_count": _over(lambda p: p.signup_count),
        "reconcile_by_icb": _over(lambda p: p.reconcile_by_icb),
        "reconcile_pharmacy_list": _over(lambda p: p.pharmacy_list),
        # Scorecards
        "national_scorecard": _over(lambda p: p.national),
        "headline_values": _over(lambda p: scorecards.headline_values(p.national)),
        "icb_scorecard": _over(lambda p: p.icb_card),
        "icb_scorecard_all_areas": _over(lambda p: p.icb_card_for(keep_all_areas=True)),
        "icb_display": _over(lambda p: scorecards.icb_display(p.icb_card)),
        "regional_scorecard": _over(lambda p: p.regional),
        "region_icb_detail": _over(lambda p: p.region_detail()),
        "region_icb_detail_one": _over(lambda p: p.region_detail(LONDON)),
        # Trends and text
        "weekly_trend": _over(lambda p: p.trend),
        "trend_range": _over(lambda p: trends.trend_range(p.trend)),
        "trend_range_na_rm": _over(lambda p: trends.trend_range(p.trend, na_rm=True)),
        "regional_long": _over(lambda p: trends.regional_long(p.regional)),
        "narrative": _over(lambda p: p.narrative()),
        "narrative_na_rm": _over(lambda p: p.narrative(na_rm=True)),
        # Maps
        "icb_choropleth_pharm1st": _over(lambda p: _numbered_choropleth(p, p1)),
        "icb_choropleth_contraception": _over(lambda p: _numbered_choropleth(p, oc)),
        "icb_choropleth_signup_gap": _over(lambda p: _numbered_choropleth(p, gap)),
        "contractor_points_pharm1st": _over(lambda p: p.points(p1)),
        "contractor_points_contraception": _over(lambda p: p.points(oc)),
        "contractor_status_pharm1st": _over(lambda p: p.status(p1)),
        "contractor_status_contraception": _over(lambda p: p.status(oc)),
        "bng_to_wgs84": _over(
            lambda p: maps.with_lon_lat(p.inputs.postcodes).select(
                "postcode", F.round("lon", 5).alias("lon"), F.round("lat", 5).alias("lat")
            )
        ),
        "map_titles": _over(
            lambda p: p.last_dates(na_rm=True).select(
                maps.map_title(p1, "last_pharm1st").alias("area_pharm1st"),
                maps.map_title(oc, "last_contraception").alias("area_contraception"),
                maps.map_title(gap, "last_pharm1st").alias("area_signup_gap"),
                maps.point_map_title(p1, "last_pharm1st").alias("points_pharm1st"),
                maps.point_map_title(oc, "last_contraception").alias("points_contraception"),
            )
        ),
        # Column rules on raw tables
        "parse_dates": _text_dates,
        "week_floor": _weeks,
        "first_by": _first_order,
        # Sources
        "landed_pharm1st": _landed(
            "pharm1st",
            {f.name: f.heading for f in readers.SCHEMAS["pharm1st"]},
            _dmy("opt_in_date"),
            "Pharmacy First opt in.csv",
        ),
        "landed_bp": _landed(
            "bp_reg",
            {f.name: f.heading for f in readers.SCHEMAS["bp_reg"]},
            _dmy("reg_date"),
            "Hypertension list.csv",
        ),
        "landed_dereg": _landed(
            "contraception_dereg", {"ods_code": "Code", "icb": "Board"}, lambda df: df, "Contraception dereg.csv"
        ),
        "landed_contraception_opt": _landed(
            "contraception_opt",
            {f.name: f.heading for f in readers.SCHEMAS["contraception_opt"]},
            lambda df: df,
            "Contraception service.csv",
        ),
        "landed_contraception_reg": _landed(
            "contraception_reg",
            {f.name: f.heading for f in readers.SCHEMAS["contraception_reg"]},
            lambda df: df,
            "Contraception reg.csv",
        ),
        "landed_hundred_hour": _hundred_hour,
        "landed_line_breaks": _broken_lines,
        "membership_typed_keys": _typed_membership,
        "landed_postcodes": _landed_postcodes,
        "landed_boundaries": _landed_boundaries,
        "landed_boundaries_collection": _landed_collection,
        "stored_contractor": lambda spark, sf_dir: _stored("ref_contractor", "parquet")(spark, sf_dir).contractor,
        "stored_icb_short": lambda spark, sf_dir: _stored("icb_short", "table")(spark, sf_dir).inputs.icb_short,
        "stored_pharm_list": _stored_pharm_list,
        # Sinks
        "report_national": _written("National", lambda p: p.national),
        "report_regional": _written("Regional", lambda p: p.regional),
        "report_icb": _written("ICB", lambda p: scorecards.icb_display(p.icb_card)),
        "report_pharmacy_level": _written("Pharmacy Level", lambda p: p.pharmacy_list),
        "report_by_region": _written("By region", lambda p: p.region_detail()),
        "report_map_layers": _written_layers,
        "report_folders": _folders,
        "report_manifest": _manifest,
        "order_icb": _ordered(
            lambda p: p.icb_card, [], _uptake("icb_code", "region_name"), "icb_code", "region_name", "pct_pharm1st"
        ),
        "order_regional": _ordered(lambda p: p.regional, [], _uptake("region"), "region", "pct_pharm1st"),
        "order_region_detail": _ordered(
            lambda p: p.region_detail(), ["region_name"],
            _uptake("icb", "total_contractors", "pharm1st_opted_in", "contraception_opted_in"),
            "region_name", "icb", "pct_pharm1st",
        ),
    }
    for name in ("trend", "trend_range", "headline", "regional_long", f"map_{p1}", f"map_{oc}", f"map_{gap}"):
        out[f"deck_{name}"] = _deck(name)
    for part in ("trend", "headline", "regional", "icb", "map"):
        out[f"contraception_{part}"] = _over(lambda p, part=part: _flat(p.contraception_pack()[part]))
    return out


def _flat(df: DataFrame) -> DataFrame:
    return df.drop("breaks") if "breaks" in df.columns else df
