"""Published tables as dated folders of CSV (with headings) or Parquet."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from muster import labels

# Tables whose headings differ from the common ones.
HEADINGS = {"National": labels.DISPLAY_NATIONAL}


def with_headings(df: DataFrame, headings: Mapping[str, str] = labels.DISPLAY) -> DataFrame:
    """Internal column names replaced by the published headings."""
    return df.withColumnsRenamed({c: headings[c] for c in df.columns if c in headings})


def _write(df: DataFrame, path: str, fmt: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_report(tables: Mapping[str, DataFrame], path: str, as_of: date, fmt: str = "csv") -> dict[str, str]:
    """One folder per table under ``path/Pharm1st_OptIn_<date>``; returns the folder of each table."""
    root = f"{path.rstrip('/')}/Pharm1st_OptIn_{as_of.isoformat()}"
    written = {}
    for name, df in tables.items():
        shown = with_headings(df, HEADINGS.get(name, labels.DISPLAY)) if fmt == "csv" else df
        written[name] = _write(shown, f"{root}/{name.replace(' ', '_')}", fmt)
    return written


def write_by_region(detail: DataFrame, path: str, as_of: date, fmt: str = "csv") -> str:
    """The area detail of all regions in one job, one sub-folder per region."""
    keyed = detail.withColumnRenamed("region_name", "region_folder")
    shown = with_headings(keyed) if fmt == "csv" else keyed
    return _write(shown, f"{path.rstrip('/')}/opt_in_by_region_{as_of.isoformat()}", fmt, ["region_folder"])


def write_points(points: DataFrame, path: str, as_of: date, fmt: str = "parquet") -> str:
    """Provider map layers, one sub-folder per service and layer.

    ``points`` has a ``service`` column, and ``position`` gives each layer's drawing order over all its files. The folder
    carries the month.
    """
    return _write(points, f"{path.rstrip('/')}/opt_in_map_{as_of.strftime('%B%Y')}", fmt, ["service", "layer"])


class Deck:
    """Several tables below one folder, with a manifest of what was written.

    Each table is noted with its rows and columns once it is complete. With ``resume`` a run goes on where a lost one with
    the same inputs ended: a noted table is not built again. Without it the old notes go first.
    """

    def __init__(self, spark: SparkSession, path: str, as_of: date, resume: bool = False):
        self.spark, self.root = spark, f"{path.rstrip('/')}/deck_{as_of.isoformat()}"
        if not resume:
            notes, files = self._file("manifest")
            files.delete(notes, True)

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _noted(self, name: str) -> bool:
        mark, files = self._file(f"manifest/table={name}/_SUCCESS")
        return files.exists(mark)

    def write(self, name: str, build: Callable[[], DataFrame], fmt: str = "parquet") -> str:
        """Write the table that ``build`` returns unless it is noted; its rows are counted in the same pass."""
        path = f"{self.root}/{name}"
        if not self._noted(name):
            counted = Observation(f"deck {name}")
            table = build()
            _write(table.observe(counted, F.count(F.lit(1)).alias("n_rows")), path, fmt)
            note = self.spark.createDataFrame([(path, fmt, counted.get["n_rows"], table.columns)], _NOTE)
            note.coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest/table={name}")
        return path

    def manifest(self) -> DataFrame:
        """table, path, format, n_rows, columns of every complete table."""
        return self.spark.read.schema(f"{_NOTE}, `table` string").json(f"{self.root}/manifest")


_NOTE = "path string, format string, n_rows bigint, columns array<string>"
