"""Map-ready tables: area classes and provider points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster import labels
from muster.functions import bng_to_wgs84, date_text, label, max_na
from muster.operators.joins import na_join

MEASURES = {
    labels.PHARM1ST: "pct_pharm1st",
    labels.CONTRACEPTION: "pct_contraception",
    labels.SIGNUP_GAP: "pct_signed_not_opted",
}


def quantile_breaks(value: Column | str, classes: int = 5) -> Column:
    """Class limits at equally spaced quantiles (linear interpolation), repeated limits removed."""
    probs = F.array(*[F.lit(i / classes) for i in range(classes + 1)])
    return F.array_distinct(F.transform(F.percentile(value, probs), lambda b: F.round(b, 6)))


def quantile_class(value: Column, breaks: Column) -> Column:
    """1-based class: intervals closed on the left, the last one on both sides; NULL for NULL."""
    last = F.greatest(F.size(breaks) - 1, F.lit(1))
    below = F.size(F.filter(breaks, lambda b: b <= F.round(value, 6)))
    return F.when(value.isNotNull(), F.least(below, last))


def icb_choropleth(table: DataFrame, boundaries: DataFrame, measure: str, classes: int = 5) -> DataFrame:
    """Areas with a boundary, their measure and its quantile class.

    ``measure`` is a key of ``MEASURES``; ``table`` is an area scorecard or a reconciliation by area. The
    limits come from one aggregate over the mapped areas, a table of one row per area.
    """
    chosen = table.select("icb_code", F.col(MEASURES[measure]).alias("value"))
    drawn = na_join(chosen, boundaries.where(F.col("icb_name").isNotNull()), "icb_code", "inner")
    breaks = drawn.agg(quantile_breaks("value", classes)).scalar()
    return drawn.withColumn("breaks", breaks).select(
        "icb_code", "icb_name", "value", quantile_class(F.col("value"), F.col("breaks")).alias("class"), "breaks"
    )


def map_title(service: str, last_date: Column | str) -> Column:
    """Title of an area map."""
    day = F.coalesce(F.col(last_date) if isinstance(last_date, str) else last_date, F.lit("NA"))
    if service == labels.SIGNUP_GAP:
        head = labels.GAP_MAP_TITLE
    else:
        head = labels.AREA_MAP_TITLE.format(labels.AREA_MAP_SERVICE[service])
    return F.concat(F.lit(head), day)


def point_map_title(service: str, last_date: Column | str) -> Column:
    """Title of a provider map."""
    day = F.coalesce(F.col(last_date) if isinstance(last_date, str) else last_date, F.lit("NA"))
    return F.concat(F.lit(labels.POINT_MAP_TITLE.format(labels.POINT_MAP_SERVICE[service])), day)


def last_opt_in(opt_in: DataFrame, na_rm: bool = False) -> Column:
    """Latest opt-in date of a list as a scalar subquery, for titles."""
    return opt_in.agg(date_text(max_na("opt_in_date", na_rm))).scalar()


def geocode(points: DataFrame, places: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Add easting and northing by postcode; ``places`` holds every postcode in use.

    The directory is the large side: it is first cut to the postcodes in use, so only those rows are
    shuffled to the join. Spark broadcasts the distinct postcodes if they are few, and shuffles otherwise.
    """
    directory = postcodes.select("postcode", "easting", "northing")
    used = na_join(directory, places, "postcode", "left_semi")
    return na_join(points, used, "postcode", "left")


def contractor_points(opt_in: DataFrame, roster: DataFrame, postcodes: DataFrame, service: str) -> DataFrame:
    """Every roster provider with its opt-in rows (or none), labels and grid coordinates."""
    claim = ["registered_for_cpcs"] if service == labels.PHARM1ST else []
    listed = opt_in.select(
        F.col("ods_code").alias("fcode"), "opted_in", *claim, "opt_in_date", "name", "phone", "lpc_code", "lpc_name"
    )
    base = roster.select("fcode", "postcode", "stp_code", "short_icb_name", "region_name", "trading_name")
    merged = na_join(base, listed, "fcode", "left", hot_keys=True)
    shaped = merged.select(
        "fcode",
        F.coalesce("opted_in", F.lit(False)).alias("opted_in"),
        *claim,
        "opt_in_date",
        "postcode",
        F.coalesce("name", "trading_name").alias("name"),
        "phone",
        label("lpc_code", "lpc_name").alias("lpc"),
        label("stp_code", "short_icb_name").alias("icb"),
        "region_name",
        "trading_name",
    )
    return geocode(shaped, base, postcodes)


def contractor_status(points: DataFrame, service: str) -> DataFrame:
    """Traffic-light colour, layer and draw order of every provider that can be placed.

    On the layer of opted-in providers only the colours of its legend exist, so a provider whose
    registration claim is missing has a NULL colour there and is drawn last.
    """
    placed = points.where(F.col("postcode").isNotNull() & F.col("easting").isNotNull())
    opted = F.col("opted_in")
    if service == labels.PHARM1ST:
        claim = F.col("registered_for_cpcs")
        colour = F.when(opted & claim, F.lit("Green")).when(opted & ~claim, F.lit("Amber"))
        colour = F.when(opted, colour).otherwise(F.lit("Red"))
    else:
        colour = F.when(opted, F.lit("Green")).otherwise(F.lit("Red"))
    ranks = F.create_map(F.lit("Green"), F.lit(1), F.lit("Amber"), F.lit(2), F.lit("Red"), F.lit(1))
    return (
        placed.withColumn("colour", colour)
        .withColumn("draw_order", F.coalesce(F.when(F.col("colour").isNotNull(), ranks[F.col("colour")]), F.lit(3)))
        .select(
            F.when(opted, F.lit("opted_in")).otherwise(F.lit("not_opted_in")).alias("layer"),
            "colour",
            "draw_order",
            "fcode",
            "name",
            "phone",
            "lpc",
            "icb",
            "region_name",
            "opt_in_date",
            "postcode",
            "easting",
            "northing",
        )
    )


def draw_order() -> list[Column]:
    """Row order within the layers; the row's own values break ties."""
    return [F.col("layer").desc(), *[F.col(c).asc_nulls_last() for c in ("draw_order", "fcode", "opt_in_date", "phone", "name", "postcode", "easting", "northing")]]


def legend(service: str) -> Column:
    """The legend text of a provider's colour, NULL for a provider without one."""
    texts = labels.LEGEND[service]
    return F.create_map(*[F.lit(x) for pair in texts.items() for x in pair])[F.col("colour")]


def with_lon_lat(points: DataFrame) -> DataFrame:
    """Web-map coordinates of located points."""
    return bng_to_wgs84(points, "easting", "northing")
