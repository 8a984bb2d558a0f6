"""The set of inputs one report run works on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from muster.sources.readers import read_boundaries, read_jdbc, read_landed, read_postcodes, read_sheet, read_table

# The registers, then the weekly sheets, then the lookups.
STORED = ("ref_contractor", "pharm_list", "icb_short", "service_registrations", "service_deregistrations")
SHEETS = ("pharm1st", "contraception_opt", "contraception_reg", "contraception_dereg", "bp_reg")
LOOKUPS = ("hundred_hour", "postcodes", "boundaries")


#: How an input is opened, by kind: (session, input, place, options).
OPENERS: dict[str, Callable[..., DataFrame]] = {
    "parquet": lambda spark, name, at, **options: read_table(spark, name, at, **options),
    "table": lambda spark, name, at, **options: read_table(spark, name, table=at, **options),
    "jdbc": lambda spark, name, at, **options: read_jdbc(spark, name, at, **options),
    "sheet": lambda spark, name, at, **options: read_sheet(spark, at, name, **options),
    "landed": lambda spark, name, at, **options: read_landed(spark, at, name, **options),
    "directory": lambda spark, name, at, **options: read_postcodes(spark, at, **options),
    "geojson": lambda spark, name, at, **options: read_boundaries(spark, at, **options),
}


@dataclass(frozen=True)
class Source:
    """Where one input lies: its kind (a key of ``OPENERS``), its place (path, folder, table or database address) and
    the reader's options."""

    kind: str
    at: str
    options: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in OPENERS:
            raise ValueError(f"unknown kind {self.kind!r}; known are {sorted(OPENERS)}")

    def open(self, spark: SparkSession, name: str) -> DataFrame:
        return OPENERS[self.kind](spark, name, self.at, **self.options)


class Inputs:
    """Inputs by name, each given as a DataFrame or as a function that opens it on first use.

    A report that needs three inputs thus never lists or opens the files of the others.
    """

    ref_contractor: DataFrame
    pharm_list: DataFrame
    hundred_hour: DataFrame
    icb_short: DataFrame
    pharm1st: DataFrame
    contraception_opt: DataFrame
    contraception_reg: DataFrame
    contraception_dereg: DataFrame
    bp_reg: DataFrame
    service_registrations: DataFrame
    service_deregistrations: DataFrame
    postcodes: DataFrame
    boundaries: DataFrame

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]):
        unknown = set(sources) - {*STORED, *SHEETS, *LOOKUPS}
        if unknown:
            raise ValueError(f"unknown inputs {sorted(unknown)}")
        self._sources = sources

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._sources:
            raise AttributeError(f"input {name!r} was not given")
        source = self._sources[name]
        df = source if isinstance(source, DataFrame) else source()
        setattr(self, name, df)
        return df

    @classmethod
    def from_sources(cls, spark: SparkSession, **sources: Source | DataFrame | Callable[[], DataFrame]) -> Inputs:
        """Any mix of places: a register from the catalog beside a landed sheet beside a frame that is there already.

        A provider list stored ``partitionBy("snapshot_month")`` is read for the wanted month only.
        """
        return cls(**{n: partial(s.open, spark, n) if isinstance(s, Source) else s for n, s in sources.items()})

    @classmethod
    def from_landing(
        cls,
        spark: SparkSession,
        tables: str,
        sheets: str,
        hundred_hour: str,
        postcodes: str,
        boundaries: str,
        boundary_lines: bool = False,
    ) -> Inputs:
        """Read from landing folders.

        ``tables`` holds the register tables as Parquet, one folder each (the provider list best stored
        ``partitionBy("snapshot_month")``); ``sheets`` holds the weekly sheets; the rest are paths.
        ``boundaries`` is Parquet, or with ``boundary_lines`` GeoJSON with one feature per line, or a GeoJSON collection.
        """
        stored = {n: partial(read_table, spark, n, f"{tables}/{n}") for n in STORED}
        landed = {n: partial(read_landed, spark, sheets, n) for n in SHEETS}
        return cls(
            **stored,
            **landed,
            hundred_hour=partial(read_sheet, spark, hundred_hour, "hundred_hour"),
            postcodes=partial(read_postcodes, spark, postcodes),
            boundaries=partial(read_boundaries, spark, boundaries, boundary_lines),
        )
