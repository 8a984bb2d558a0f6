"""Exact dedup by composable polynomial fingerprints.

A normalised text is cut into chunks of equal size. Each chunk is hashed on its own, in whatever task it lands:
``h = sum(byte[i] * B**i) mod p``. Shifted by ``B**start`` the hashes of a text's chunks simply add up to the
hash of the whole, so the chunks of a huge document are spread over the cluster and combined by a sum. Four primes
make a fingerprint of 124 bits, grouped together with the length.

Equal fingerprints are then compared chunk by chunk with the row that would stay. Rows that differ from it (a
collision) form the next round's groups, until none are left, so the result is exact.

Defined cases: NULL text counts as empty, and empty texts equal each other. A NULL doc_id sorts last. Of rows with
the same doc_id and text one stays. A doc_id may have any type that has an order. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import KEYS, SPACE, key_columns, keep_one_each
from muster.plans.staging import Staging

# Primes just under 2**31 and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525, 69069, 48271)

CHUNK_BYTES = 1 << 18
_PIECE = 1 << 20


def strip_space(text: Column) -> Column:
    """The text without any white space of the class [\\x20\\x09-\\x0D]."""
    return F.regexp_replace(text, SPACE + "+", "")


@lru_cache(maxsize=16)
def powers(base: int, prime: int, n: int) -> np.ndarray:
    """``base**i mod prime`` for i < n, doubled up so that no loop runs over the elements."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[:n]


def _sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, base: int, prime: int, longest: int) -> np.ndarray:
    """The unshifted hash of each of the chunks that lie one after the other in ``data``."""
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(lengths)
    if len(full):
        place = np.arange(len(data)) - np.repeat(starts[full], lengths[full])
        terms = data * powers(base, prime, longest)[place]
        out[full] = np.add.reduceat(terms, starts[full]) % np.uint64(prime)
    return out


def _hash_chunks(primes: tuple, bases: tuple, chunk_bytes: int):
    """Turns ``chunk, bytes`` of each row into its hashes, shifted to the chunk's place; other columns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            column = batch.column("bytes").cast(pa.binary())
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            # A caller's normalisation may lengthen a text that was short enough before it.
            most = int(np.diff(offsets).max(initial=0))
            longest = chunk_bytes if most <= chunk_bytes else 1 << most.bit_length()
            parts = [np.zeros(len(batch), np.uint64) for _ in primes]
            at = 0
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _PIECE, "right")) - 1)
                piece, starts = data[offsets[at] : offsets[end]].astype(np.uint64), offsets[at:end] - offsets[at]
                for k, (prime, base) in enumerate(zip(primes, bases, strict=True)):
                    parts[k][at:end] = _sums(piece, starts, np.diff(offsets[at : end + 1]), base, prime, longest)
                at = end
            for k, (prime, base) in enumerate(zip(primes, bases, strict=True)):
                where, which = np.unique(numbers, return_inverse=True)
                shift = np.array([pow(base, int(n) * chunk_bytes, prime) for n in where], np.uint64)[which]
                parts[k] = (parts[k] * shift % np.uint64(prime)).astype(np.int64)
            kept = [c for c in batch.schema.names if c not in ("chunk", "bytes")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *map(pa.array, parts)], names=[*kept, "h0", "h1", "h2", "h3"]
            )

    return run


def _chunks(texts: DataFrame, chunk_bytes: int, *columns: str) -> DataFrame:
    """One row per chunk of the normalised bytes ``norm``; an empty text has one empty chunk."""
    last = F.floor(F.greatest(F.octet_length("norm") - 1, F.lit(0)) / chunk_bytes).cast("int")
    return texts.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk")).select(
        *KEYS, *columns, "chunk", F.substring("norm", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("bytes")
    )


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), *key_columns(doc_id, text), F.coalesce(text, F.lit("")).alias("whole"))


def _normalised(texts: DataFrame, normalise: Callable[[Column], Column]) -> DataFrame:
    return texts.select("doc_id", *KEYS, F.length("whole").alias("n_chars"), normalise(F.col("whole")).cast("binary").alias("norm"))


def fingerprints(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = strip_space,
    chunk_bytes: int = CHUNK_BYTES,
    primes: tuple = PRIMES,
    bases: tuple = BASES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """k1, k2, doc_id, n_chars, text_sha256 and the fingerprint ``n_bytes, f1, f2`` of every row."""
    texts = _texts(docs, doc_id, text)
    hashing = _hash_chunks(primes, bases, chunk_bytes)
    facts = ["doc_id", "n_chars", "n_bytes", "text_sha256"]
    measures = [F.octet_length("norm").alias("n_bytes"), F.sha2("norm", 256).alias("text_sha256")]
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"k1 long, k2 long, doc_id {kind}, n_chars int, n_bytes int, text_sha256 string"
    hashes = "h0 long, h1 long, h2 long, h3 long"
    # Told apart by size before normalising, so that each text is normalised once. A sum is the same however it is cut.
    size = F.octet_length("whole")
    short = _normalised(texts.where(size <= chunk_bytes), normalise).select("*", *measures)
    # Texts of one chunk are hashed in place; huge ones are dealt out by chunk, rows of one key together.
    one = short.select(*KEYS, *facts, F.lit(0).alias("chunk"), F.col("norm").alias("bytes"))
    one = one.mapInArrow(hashing, f"{schema}, {hashes}")
    huge = _normalised(texts.where(size > chunk_bytes), normalise).select("*", *measures)
    pieces = _chunks(huge, chunk_bytes, *facts).groupBy(*KEYS, "chunk").agg(
        *[F.first(c).alias(c) for c in facts], F.count(F.lit(1)).cast("int").alias("rows"), F.first("bytes").alias("bytes")
    )
    pieces = pieces.select(*KEYS, *facts, "rows", "chunk", "bytes")
    sums = pieces.mapInArrow(hashing, f"{schema}, rows int, {hashes}").groupBy(*KEYS).agg(
        *[F.first(c).alias(c) for c in facts], F.max("rows").alias("rows"),
        *[(F.sum(f"h{k}") % F.lit(p)).alias(f"h{k}") for k, p in enumerate(primes)],
    )
    many = sums.select("*", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("rows", "col")
    return one.unionByName(many).select(
        "doc_id", *KEYS, "n_chars", "text_sha256", "n_bytes",
        (F.col("h0") * F.lit(1 << 31) + F.col("h1")).alias("f1"),
        (F.col("h2") * F.lit(1 << 31) + F.col("h3")).alias("f2"),
    )


def exact_groups(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = strip_space,
    chunk_bytes: int = CHUNK_BYTES,
    primes: tuple = PRIMES,
    bases: tuple = BASES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, k1, k2, keep_id, group_size, kept, text_sha256, and the group's key g1, g2.

    Of equal texts the row with the most code points stays, then the smallest doc_id.
    """
    spark = docs.sparkSession
    staging = Staging(spark)
    prints = staging.keep(fingerprints(docs, normalise, chunk_bytes, primes, bases, doc_id, text), "prints")

    pending = prints.select(*KEYS, "doc_id", "n_chars", F.array("n_bytes", "f1", "f2").alias("same"))
    chunks, settled, turn = None, [], 0
    while True:
        # Smallest struct: most code points, then the smallest doc_id with NULL last, then the key.
        order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", *KEYS)
        heads = pending.groupBy("same").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("n"))
        heads = heads.where("n > 1").select("same", F.col("head.k1").alias("g1"), F.col("head.k2").alias("g2"))
        # Written, so that the join below reads both sides from shuffles of its own and a hot group can be split.
        heads = staging.keep(heads, f"heads{turn}")
        members = staging.keep(
            pending.join(heads, "same").select(*KEYS, "g1", "g2", "doc_id", "n_chars"), f"members{turn}"
        )
        if chunks is None:
            # The texts of rows that share a fingerprint, and of no others.
            shared = members.select(*KEYS).distinct().hint("merge")  # the same plan at every size
            texts = _texts(docs, doc_id, text).join(shared, KEYS).dropDuplicates(KEYS)
            chunks = staging.keep(_chunks(_normalised(texts, normalise), chunk_bytes), "chunks")
        pairs = members.select(*KEYS, "g1", "g2").distinct()
        mine = pairs.join(chunks, KEYS)
        theirs = pairs.where("k1 = g1 AND k2 = g2").join(chunks, KEYS).select(
            "g1", "g2", "chunk", F.col("bytes").alias("head_bytes")
        )
        unequal = mine.join(theirs, ["g1", "g2", "chunk"], "left").where(~F.col("bytes").eqNullSafe(F.col("head_bytes")))
        unequal = staging.keep(unequal.select(*KEYS).distinct(), f"unequal{turn}")
        if unequal.isEmpty():
            settled.append(members.select(*KEYS, "g1", "g2"))
            break
        settled.append(members.join(unequal, KEYS, "left_anti").select(*KEYS, "g1", "g2"))
        again = members.join(unequal, KEYS, "left_semi")
        pending = again.select(*KEYS, "doc_id", "n_chars", F.array("g1", "g2").alias("same"))
        turn += 1

    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    rows = prints.join(found.distinct(), KEYS, "left")
    rows = rows.withColumns({"g1": F.coalesce("g1", "k1"), "g2": F.coalesce("g2", "k2")})
    nth = F.row_number().over(Window.partitionBy(*KEYS).orderBy("n_chars"))
    rows = rows.withColumn("kept", (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")) & (nth == 1))
    rows = staging.keep(rows, "rows")
    sizes = rows.groupBy("g1", "g2").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.when(F.col("kept"), F.col("doc_id"))).alias("keep_id")
    )
    return rows.join(staging.keep(sizes, "sizes"), ["g1", "g2"]).select(
        "doc_id", *KEYS, "keep_id", "group_size", "kept", "text_sha256", "g1", "g2"
    )


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = exact_groups(docs, **options)
    return keep_one_each(docs, groups.where("kept").select(*KEYS))
