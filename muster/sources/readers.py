"""Reading tables, landed sheets, the postcode directory and area boundaries."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.functions import parse_date
from muster.plans.staging import Staging
from muster.sources.schemas import POSITIONAL, PREFIXES, SCHEMAS, Field


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _typed(source: Column, source_type: T.DataType, field: Field) -> Column:
    """Cast to the declared type; text dates are parsed, unreadable text becomes NULL."""
    if field.type == "date" and isinstance(source_type, T.StringType):
        return parse_date(source, field.style)
    if isinstance(source_type, T.StringType):
        return source.try_cast(field.type)
    return source.cast(field.type)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project a table to the declared columns and types of input ``name``.

    Columns are found by internal name or by landed heading, except for positional inputs, which must
    have exactly the declared width. A missing column is an error.
    """
    fields = SCHEMAS[name]
    if name in POSITIONAL:
        if len(df.columns) != len(fields):
            raise ValueError(f"{name}: expected {len(fields)} columns, found {len(df.columns)}")
        df = df.toDF(*[f.name for f in fields])
    types = {f.name: f.dataType for f in df.schema}
    picked, missing = [], []
    for field in fields:
        found = next((n for n in (field.name, field.heading) if n in types), None)
        if found is None:
            missing.append(field.heading or field.name)
        else:
            picked.append(_typed(_quoted(found), types[found], field).alias(field.name))
    if missing:
        raise ValueError(f"{name}: missing columns {missing}; found {df.columns}")
    return df.select(*picked)


def read_table(spark: SparkSession, name: str, path: str | None = None, table: str | None = None) -> DataFrame:
    """An input stored as Parquet at ``path``, or as a catalog table (``table``, or its own name)."""
    source = spark.read.parquet(path) if path else spark.table(table or name)
    return conform(source, name)


def read_jdbc(spark: SparkSession, name: str, url: str, table: str, split: dict | None = None, **options) -> DataFrame:
    """An input kept in a remote database.

    Filters and column choice on the result are sent to the database. ``split`` (``column``, ``lower``,
    ``upper``, ``partitions``) reads a large table through that many parallel range queries.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split:
        reader = reader.options(
            partitionColumn=split["column"],
            lowerBound=split["lower"],
            upperBound=split["upper"],
            numPartitions=split["partitions"],
        )
    return conform(reader.load(), name)


def find_one(spark: SparkSession, folder: str, prefix: str) -> str:
    """Path of the single entry of ``folder`` whose name starts with ``prefix``, ignoring case.

    An entry is a file, or a folder of part files. Anything but exactly one match is an error.
    """
    base = folder.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    # One level of the folder; the files of an entry that is a folder are not listed.
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    found = {e.getPath().getName() for e in entries}
    names = sorted(n for n in found if n.lower().startswith(prefix.lower()) and n[0] not in "._")
    if len(names) != 1:
        raise ValueError(f"{base}: expected one entry starting with {prefix!r}, found {names[:3] or 'none'}")
    return f"{base}/{names[0]}"


_BROKEN = "__broken_row"


def _checks(raw: DataFrame, name: str) -> dict[str, Column]:
    """Counts of what would be lost in ``conform``: non-empty text that does not parse, by column, and broken rows."""
    typed = conform(raw.drop(_BROKEN), name).schema
    named = raw
    if name in POSITIONAL:
        named = raw.drop(_BROKEN).toDF(*[f.name for f in SCHEMAS[name]])
    shown = dict(zip(named.columns, raw.columns, strict=False))
    types = {f.name: f.dataType for f in named.schema}
    found = {}
    for field in SCHEMAS[name]:
        source = next(n for n in (field.name, field.heading) if n in types)
        if isinstance(types[source], T.StringType) and typed[field.name].dataType != types[source]:
            text = _quoted(shown[source])
            found[field.name] = F.count_if((F.trim(text) != "") & _typed(text, types[source], field).isNull())
    if _BROKEN in raw.columns:
        found["broken rows"] = F.count_if(_quoted(_BROKEN).isNotNull())
    return found


def _landed_once(raw: DataFrame, name: str, path: str, tolerate: dict[str, int] | None, staging: Staging | None) -> DataFrame:
    """A text input typed and written as Parquet in the one pass that also counts what it would lose.

    Anything lost is an error with its counts, except as many as ``tolerate`` allows; what is tolerated becomes NULL and
    broken rows go. Later passes read typed columns and never parse the text again.
    """
    checks = _checks(raw, name)
    if not checks:
        return conform(raw, name)
    staging = staging or Staging(raw.sparkSession)
    seen = Observation(f"{name} {uuid.uuid4().hex}")
    watched = raw.observe(seen, *[c.alias(f"c{i}") for i, c in enumerate(checks.values())])
    whole = watched.where(_quoted(_BROKEN).isNull()) if _BROKEN in raw.columns else watched
    table = f"landed-{name}-{uuid.uuid4().hex}"
    kept = staging.keep(conform(whole.drop(_BROKEN), name), table)
    lost = {what: seen.get[f"c{i}"] for i, what in enumerate(checks)}
    beyond = {what: n for what, n in lost.items() if n > (tolerate or {}).get(what, 0)}
    if beyond:
        staging.drop(table)
        raise ValueError(f"{name}: unreadable in {path}: {beyond}")
    return kept


def _csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Every column as text, and the text of rows that do not have the headings' width."""
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    # Both quotes of a value doubled inside are the sheets' way to write one.
    reader = reader.option("escape", '"')
    # Rows are measured whole, whichever columns are wanted.
    reader = reader.option("columnPruning", False)
    headings = reader.csv(path).columns
    every = T.StructType([T.StructField(h, T.StringType()) for h in (*headings, _BROKEN)])
    return reader.schema(every).option("columnNameOfCorruptRecord", _BROKEN).csv(path)


def read_sheet(
    spark: SparkSession,
    path: str,
    name: str,
    multi_line: bool = True,
    tolerate: dict[str, int] | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """An input landed as CSV with a heading row, or as Parquet (the form for large inputs).

    ``multi_line`` reads quoted line breaks as part of their value, each file in one task; without it files are
    split, and a row with a line break is broken. The text is read once: it is written as typed Parquet (in ``staging``, or a
    folder of its own) while rows that do not have the headings' width, and texts that are not the date, number or truth
    value they should be, are counted. Any is an error, except as many as ``tolerate`` allows by column (or under ``broken
    rows``). What is tolerated becomes NULL; broken rows go.
    """
    columnar = path.rstrip("/").lower().endswith(".parquet")
    raw = spark.read.parquet(path) if columnar else _csv(spark, path, multi_line)
    return _landed_once(raw, name, path, tolerate, staging)


def read_landed(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """An input landed in ``folder`` under a name known only by its leading text; options as in ``read_sheet``."""
    return read_sheet(spark, find_one(spark, folder, PREFIXES[name]), name, **options)


def read_postcodes(
    spark: SparkSession, path: str, tolerate: dict[str, int] | None = None, staging: Staging | None = None
) -> DataFrame:
    """Postcode directory, checked like a sheet in the one pass that reads it; files are split, so a quoted line break
    is a broken row. Its many columns are measured and only the three declared ones are kept."""
    columnar = path.rstrip("/").lower().endswith(".parquet")
    raw = spark.read.parquet(path) if columnar else _csv(spark, path, multi_line=False)
    return _landed_once(raw, "postcodes", path, tolerate, staging)


_FEATURE = T.StructType(
    [
        T.StructField(
            "properties",
            T.StructType([T.StructField("icb_code", T.StringType()), T.StructField("icb_name", T.StringType())]),
        ),
        # Declared as text so that the reader keeps the raw JSON of any shape type.
        T.StructField("geometry", T.StringType()),
    ]
)


#: How writers begin a feature; what stands between its first two keys differs.
_FEATURE_START = r'\{\s*"type"\s*:\s*"Feature"\s*,\s*'


def _feature_start(spark: SparkSession, path: str) -> str | None:
    """The text with which the first feature of a collection begins, from the head of its first file."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    inside = sorted(str(e.getPath()) for e in files.listStatus(folder) if e.isFile() and e.getPath().getName()[0] not in "._")
    if not inside:
        return None
    stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(inside[0]))
    try:
        head = bytes(stream.readNBytes(_HEAD)).decode("utf-8", "ignore")
    finally:
        stream.close()
    found = re.search(_FEATURE_START, head)
    return found.group(0) if found else None


_HEAD = 1 << 16


def read_boundaries(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Area boundaries: code, name and the shape as opaque JSON text.

    ``path`` is a GeoJSON feature collection, or with ``lines=True`` one feature per line, or Parquet with those
    three columns. Spark splits all three across tasks however large the file: a collection is cut where its features
    begin, by the very text with which its first feature begins (quotes inside a value are escaped, so the cut cannot fall
    into one). A piece that is no feature with properties and a shape is an error, so a collection whose features are
    written in several ways is refused rather than read in part. One whose first feature does not begin with its type
    is read whole by one task.
    """
    if path.rstrip("/").lower().endswith(".parquet"):
        return spark.read.parquet(path).select("icb_code", "icb_name", "geometry")
    if lines:
        feature = spark.read.schema(_FEATURE).json(path)
    elif start := _feature_start(spark, path):
        pieces = spark.read.option("lineSep", start).text(path)
        # What comes before the first feature is the collection's own head.
        body = pieces.where(~F.ltrim("value").startswith("{") & (F.trim("value") != ""))
        read = F.from_json(F.concat(F.lit("{"), F.col("value")), _FEATURE)
        broken = F.raise_error(F.concat(F.lit("not a feature: "), F.substring("value", 1, 80)))
        whole = read["properties"].isNotNull() & read["geometry"].isNotNull()
        feature = body.select(F.when(whole, read).otherwise(broken.cast(_FEATURE)).alias("f")).select("f.*")
    else:
        whole = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
        collection = spark.read.schema(whole).option("multiLine", True).json(path)
        feature = collection.select(F.inline("features"))
    return feature.select("properties.icb_code", "properties.icb_name", "geometry")
