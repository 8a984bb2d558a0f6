"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (line hash, number of documents), bucketed and sorted by the hash, so runs meet in merge joins
without a shuffle. Each new batch is folded to such a run, merge-anti-joined with the run of settled lines (those
already known to be frequent need no more counting), and added on the lowest level. A level that is full is merged
into one run of the next; lines whose count has come to the threshold move to the settled runs. After the last batch
all levels are merged, so every frequent line is settled whatever the batches were.

A line that a third of all documents hold is one row of each Arrow batch, as batches are folded before the shuffle.

Defined cases: a NULL or empty text is one empty line, and lines of fewer than ``min_chars`` code points stay. Each
row counts as a document, rows that repeat one included. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.common import KEYS, keyed, partitions
from muster.plans.staging import Staging

HASH = ["h1", "h2"]
_WHITE = b" \t\n\x0b\x0c\r"
#: So many runs make a level full; with three batches more, these meet the lines that the first merge has settled.
_FANOUT = 4
_BATCHES = 7


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The 128-bit hash of each line's key; None for a key that is too short to count."""
    out: list[bytes | None] = []
    for line in text.lower().split(b"\n"):  # bytes.lower changes A-Z only
        key = line.strip(_WHITE)
        short = len(key) < min_chars or (min_chars > 1 and len(key.decode()) < min_chars)
        out.append(None if short else xxhash.xxh3_128_digest(key))
    return out


def _columns(keys: list[bytes]) -> list[pa.Array]:
    pairs = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)]


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (t.as_buffer().to_pybytes() for t in batch.column("text").cast(pa.binary()))


def _fold(min_chars: int):
    """Documents of each line, for each Arrow batch and ingest batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text, ingest in zip(_texts(batch), batch.column("ingest").to_pylist(), strict=True):
                counts.update((ingest, k) for k in set(line_keys(text, min_chars)) if k)
            ingests = pa.array([i for i, _ in counts], pa.int32())
            hashes = _columns([k for _, k in counts])
            yield pa.RecordBatch.from_arrays([ingests, *hashes, pa.array(counts.values(), pa.int64())], names=["ingest", *HASH, "docs"])

    return run


def _lines_of_documents(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = [], []
            for at, text in enumerate(_texts(batch)):
                mine = [k for k in set(line_keys(text, min_chars)) if k]
                keys += mine
                owners.append(np.full(len(mine), at))
            rows = pa.array(np.concatenate([np.zeros(0, np.int64), *owners]).astype(np.int64))
            kept = [batch.column(c).take(rows) for c in KEYS]
            yield pa.RecordBatch.from_arrays([*kept, *_columns(keys)], names=[*KEYS, *HASH])

    return run


def _strip(min_chars: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone1, gone2 = batch.column("gone1").to_pylist(), batch.column("gone2").to_pylist()
            n_lines, n_dropped, digests, texts = [], [], [], []
            for text, g1, g2 in zip(_texts(batch), gone1, gone2, strict=True):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if g1:
                    drop = set(np.column_stack([g1, g2]).astype("<i8").view("V16")[:, 0].tolist())
                    keys = line_keys(text, min_chars)
                    lines = [line for line, k in zip(lines, keys, strict=True) if k not in drop]
                n_dropped.append(n_lines[-1] - len(lines))
                kept = b"\n".join(lines)
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode() if "kept_text" in names else None)
            made = {"n_lines": n_lines, "n_dropped": n_dropped, "kept_sha256": digests, "kept_text": texts}
            kept_columns = [batch.column(c) for c in ("doc_id", *KEYS)]
            yield pa.RecordBatch.from_arrays([*kept_columns, *(pa.array(made[n]) for n in names)], names=["doc_id", *KEYS, *names])

    return run


class LineRuns:
    """The levels of one corpus, as bucketed tables in the shared folder. ``release`` ends their use."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 4):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.staging, self.name = Staging(spark), f"line_runs_{uuid.uuid4().hex}"
        self.buckets, self.written = partitions(spark), 0
        self.levels: list[list[str]] = []
        self.settled_runs: list[str] = []
        self.named: set[str] = set()

    def _write(self, df: DataFrame, *split_by: str) -> str:
        table = f"{self.name}_{self.written}"
        self.written += 1
        self.named.add(table)
        out = df.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
        (out.partitionBy(*split_by) if split_by else out).option("path", f"{self.staging.folder}/{table}").saveAsTable(table)
        return table

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.named.discard(table)
        self.staging.drop(table)

    def _run(self, table: str) -> DataFrame:
        return self.spark.table(table).select(*HASH, "docs")

    def _read(self, tables: list[str]) -> DataFrame:
        """Several runs in one, read as plain files and so dealt out anew: a columnar union of bucketed tables passes
        for partitioned by bucket in Spark's plans without being so, and sums over it came out split."""
        files = [f"{self.staging.folder}/{t}" for t in tables]
        return self.spark.read.schema("h1 long, h2 long, docs long").parquet(*files)

    def add(self, docs: DataFrame, batches: int = 1, min_chars: int = 1) -> None:
        """Take in documents in so many batches; the table is read once."""
        rows = keyed(docs).withColumn("ingest", F.pmod(F.xxhash64("k1"), F.lit(batches)).cast("int"))
        folded = rows.select("text", "ingest").mapInArrow(_fold(min_chars), "ingest int, h1 long, h2 long, docs long")
        # Hash partitioning by the line alone puts a line's batches in one task and its bucket.
        spread = folded.repartition(self.buckets, *HASH).groupBy(*HASH, "ingest").agg(F.sum("docs").alias("docs"))
        table = self._write(spread, "ingest")
        for ingest in range(batches):
            self._add_run(self.spark.table(table).where(F.col("ingest") == ingest).select(*HASH, "docs"))
        self._drop(table)

    def _add_run(self, run: DataFrame) -> None:
        for table in self.settled_runs:
            run = run.join(self._run(table).hint("merge"), HASH, "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(run))
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self._merge(self.levels[level], level + 1)
            level += 1

    def _merge(self, tables: list[str], into: int) -> None:
        """Merge runs into one of the level ``into``; lines that have come to the threshold go to the settled runs."""
        whole = self._write(self._read(tables).groupBy(*HASH).agg(F.sum("docs").alias("docs")))
        often = F.col("docs") >= self.min_docs
        self.settled_runs.append(self._write(self.spark.table(whole).where(often)))
        while len(self.levels) <= into:
            self.levels.append([])
        self.levels[into].append(self._write(self.spark.table(whole).where(~often)))
        for table in [*tables, whole]:
            self._drop(table)
        tables.clear()

    def settled(self) -> DataFrame:
        """Every line hash found in at least ``min_docs`` documents, with that number or more than the threshold."""
        rest = [t for level in self.levels for t in level]
        # A single run above the lowest level holds what a merge left below the threshold.
        if len(rest) > 1 or any(self.levels[:1]):
            self.levels = [rest]
            self._merge(rest, 1)
        if not self.settled_runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, docs long")
        return self._read(self.settled_runs)

    def release(self) -> None:
        """Take the tables' names out of the catalog. Files of settled runs stay, as ``settled`` reads them."""
        for table in self.named - set(self.settled_runs):
            self._drop(table)
        for table in self.named:
            self.spark.sql(f"DROP TABLE {table}")
        self.named, self.levels, self.settled_runs = set(), [], []


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = _BATCHES, fanout: int = _FANOUT, with_text: bool = False) -> DataFrame:
    """doc_id, k1, k2, n_lines, n_dropped, kept_sha256 (and kept_text) of every row."""
    runs = LineRuns(docs.sparkSession, min_docs, fanout)
    try:
        runs.add(docs, batches, min_chars)
        frequent = runs.settled().select(*HASH)
    finally:
        runs.release()
    rows = keyed(docs)
    held = rows.select(*KEYS, "text").mapInArrow(_lines_of_documents(min_chars), "k1 long, k2 long, h1 long, h2 long")
    # Straight to the documents: a step that groups by line as well would keep a hot line's rows in one task.
    gone = held.join(frequent, HASH, "left_semi").groupBy(*KEYS).agg(F.collect_set(F.struct(*HASH)).alias("gone"))
    names = ["n_lines", "n_dropped", "kept_sha256", *(["kept_text"] if with_text else [])]
    kinds = {"n_lines": "long", "n_dropped": "long", "kept_sha256": "string", "kept_text": "string"}
    kind = rows.schema["doc_id"].dataType.simpleString()
    marked = rows.join(gone.hint("merge"), KEYS, "left").select(
        "doc_id", *KEYS, "text", F.col("gone.h1").alias("gone1"), F.col("gone.h2").alias("gone2")
    )
    return marked.mapInArrow(_strip(min_chars, names), f"doc_id {kind}, k1 long, k2 long, " + ", ".join(f"{n} {kinds[n]}" for n in names))
