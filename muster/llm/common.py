"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of every contract, as a character class for regular expressions.
SPACE = r"[\x20\x09-\x0D]"
KEYS = ["k1", "k2"]
#: A bitmap has so many bits at most, whatever it stands for.
MOST_BITS = 1 << 27


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def key_columns(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """A 128-bit key of (doc_id, text), never NULL. Rows that agree in both share it: they are interchangeable."""
    return [F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(F.lit(1), text, doc_id).alias("k2")]


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, text (NULL read as empty) and the key, whatever else the table holds."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *columns, *key_columns())


def packed(docs: DataFrame) -> DataFrame:
    """The whole row as one struct beside its key, so that no column of ``docs`` can clash with a helper column."""
    return docs.select(F.struct(*docs.columns).alias("row"), *key_columns())


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def keep_one_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in ``kept`` (k1, k2); of rows with one key a single one."""
    first = Window.partitionBy(*KEYS).orderBy(F.xxhash64("row"))
    rows = packed(docs).withColumn("nth", F.row_number().over(first)).where("nth = 1")
    return unpacked(rows.join(kept.select(*KEYS), KEYS, "left_semi"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """The hashes of a column as a bitmap of bounded size that tasks can carry: it names every hash it was made of, and
    a few others, so it may only spare work. Sixteen bits for each hash as far as ``MOST_BITS`` go; it is put together
    by Spark and comes to the driver as one row for each 64 bits at most. Without hashes it is empty."""
    count = hashes.count()
    if not count:
        return np.zeros(0, np.uint64)
    bits = min(MOST_BITS, max(1 << 12, 1 << (16 * count - 1).bit_length()))
    at = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = hashes.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def in_bitmap(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (64-bit whole numbers) the bitmap names."""
    if not len(words):
        return np.zeros(len(hashes), bool)
    at = hashes.astype(np.int64) & (64 * len(words) - 1)
    return (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
