"""Packing by cutting-stock column generation.

Documents are cut into pieces of at most one sequence: whole sequences first, then the rest. Only the histogram of
piece lengths, at most one row per length, goes to the driver. There a linear program over packing patterns is solved
by column generation: the simplex basis gives each length class a price, a knapsack over the prices finds the pattern
that would pay most, until none pays. The pattern counts are rounded down and the few pieces left are packed
first-fit decreasing, again as counts. Patterns are then handed out: pieces get a rank within their class by a
distributed count, and the rank alone says which sequence and slot a piece goes to.

Defined cases: a NULL or blank text is the end id alone. A table without rows gives no pieces. Rows that repeat a
doc_id and text are packed on their own, each whole. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import KEYS, keyed, partitions
from muster.llm.tokens import encoder
from muster.plans.staging import Staging

SEQUENCE = 2048
END_ID = 1
#: Lengths are rounded up to classes of this width in the linear program; the mean padding of a piece is half of it.
GRAIN = 4
#: Column generation stops when no further pattern could save more than this share of the sequences.
TOLERANCE = 1e-4
MAX_COLUMNS = 2000
#: Share of the best bound's prices in the prices that the knapsack sees.
SMOOTH = 0.7


def _pieces(path: str, sequence: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            owner, start, length, crc, total, ids = [], [], [], [], [], []
            for at, text in enumerate(batch.column("text")):
                data = memoryview(encode(text.as_py()) + end)
                n = len(data) // 4
                for begin in range(0, n, sequence):
                    piece = data[4 * begin : 4 * (begin + sequence)]
                    owner.append(at)
                    start.append(begin)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
            rows = pa.array(owner, pa.int64())
            made = [pa.array(v, pa.int64()) for v in (start, length, crc, total)]
            names = ["doc_id", *KEYS, "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                made.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in ("doc_id", *KEYS)), *made], names=names)

    return run


def tokenized(docs: DataFrame, tokenizer: str, sequence: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """The pieces of every row: doc_id, k1, k2, start, length, ids_crc32, doc_tokens (and ids)."""
    rows = keyed(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k1 long, k2 long, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if with_ids else ""
    return rows.select("doc_id", *KEYS, "text").mapInArrow(_pieces(tokenizer, sequence, end_id, with_ids), schema)


def best_pattern(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the dearest multiset of sizes that fits, and its price."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1)
    for space in range(1, room + 1):
        n = np.searchsorted(sizes, space, "right")  # sizes are ascending
        gains = value[space - sizes[:n]] + prices[:n]
        best = int(np.argmax(gains)) if n else -1
        if n and gains[best] > value[space - 1]:
            value[space], last[space] = gains[best], best
        else:
            value[space], last[space] = value[space - 1], -1
    pattern, space = np.zeros(len(sizes), np.int64), room
    while space > 0:
        if last[space] < 0:
            space -= 1
        else:
            pattern[last[space]] += 1
            space -= sizes[last[space]]
    return float(value[room]), pattern


class _Basis:
    """The simplex basis of the patterns in use; ``inverse`` turns demand into amounts and gives the prices."""

    def __init__(self, sizes: np.ndarray, demand: np.ndarray, room: int):
        self.patterns = np.diag(room // sizes).astype(np.int64)
        self.inverse = np.diag(1.0 / np.diag(self.patterns))
        self.amounts = self.inverse @ demand

    @property
    def prices(self) -> np.ndarray:
        return self.inverse.sum(axis=0)

    def enter(self, pattern: np.ndarray) -> None:
        """Take in a pattern for the one whose amount comes to zero first."""
        step = self.inverse @ pattern
        gains = step > 1e-9
        ratios = np.where(gains, self.amounts / np.where(gains, step, 1), np.inf)
        out = int(np.argmin(ratios))
        self.amounts = np.maximum(self.amounts - ratios[out] * step, 0)
        self.amounts[out] = ratios[out]
        pivot = self.inverse[out] / step[out]
        self.inverse -= np.outer(step, pivot)
        self.inverse[out] = pivot
        self.patterns[out] = pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one row each) and how often the linear program uses each, so that demand is met exactly.

    The first columns are those of a first-fit packing. Prices for the knapsack are smoothed towards those that gave
    the best bound so far, which keeps them from swinging.
    """
    basis = _Basis(sizes, demand, room)
    pool = np.array([p for p, _ in first_fit(sizes, demand.astype(np.int64), room)])
    for _ in range(4 * len(pool)):
        worth = pool @ basis.prices
        if worth.max() <= 1 + 1e-9:
            break
        basis.enter(pool[int(np.argmax(worth))])
    center, bound = basis.prices, 0.0
    for _ in range(MAX_COLUMNS):
        prices, now = basis.prices, basis.amounts.sum()
        for mixed in (SMOOTH * center + (1 - SMOOTH) * prices, prices):
            worth, pattern = best_pattern(sizes, mixed, room)
            reached = float(mixed @ demand) / max(worth, 1e-12)  # Farley's bound: no packing takes fewer
            if reached > bound:
                center, bound = mixed, reached
            if pattern @ prices > 1 + 1e-9:
                break
        whole = np.ceil(now - 1e-6) <= np.ceil(bound - 1e-6)  # not one sequence less is possible
        if whole or now <= bound * (1 + tolerance) or pattern @ prices <= 1 + 1e-9:
            break
        basis.enter(pattern)
    return basis.patterns, basis.amounts


def first_fit(sizes: np.ndarray, left: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Patterns for what is left, longest first, each as often as it still fits."""
    out, left = [], left.copy()
    while left.any():
        pattern, space = np.zeros(len(sizes), np.int64), room
        for at in np.flatnonzero(left)[::-1]:
            take = min(int(left[at]), space // int(sizes[at]))
            pattern[at], space = take, space - take * int(sizes[at])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        left -= times * pattern
        out.append((pattern, times))
    return out


def plan(histogram: dict[int, int], room: int, tolerance: float = TOLERANCE) -> list[tuple[np.ndarray, int]]:
    """(pieces of each class in 0..room, times) of each pattern; together they hold the histogram exactly."""
    sizes = np.array(sorted(s for s in histogram if 0 < s < room), np.int64)
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    chosen: list[tuple[np.ndarray, int]] = []
    if len(sizes):
        patterns, amounts = column_generation(sizes, demand.astype(float), room, tolerance)
        left = demand.copy()
        for at in np.argsort(-amounts, kind="stable"):
            used = patterns[at] > 0
            times = min(int(amounts[at] + 1e-7), int((left[used] // patterns[at][used]).min()))
            if times > 0:
                left -= times * patterns[at]
                chosen.append((patterns[at], times))
        chosen += first_fit(sizes, left, room)
    wide = []
    for pattern, times in chosen:
        row = np.zeros(room + 1, np.int64)
        row[sizes] = pattern
        wide.append((row, times))
    if histogram.get(room):
        row = np.zeros(room + 1, np.int64)
        row[room] = 1
        wide.append((row, histogram[room]))
    return wide


class Slots:
    """Sequence and slot of a piece from its class and rank; the table is bounded by patterns times classes."""

    def __init__(self, patterns: list[tuple[np.ndarray, int]]):
        rows, base, used = [], 0, {}
        for pattern, times in patterns:
            slot = 0
            for size in np.flatnonzero(pattern)[::-1].tolist():
                each, at = int(pattern[size]), used.get(size, 0)
                rows.append((size, at, each, base, slot))
                used[size], slot = at + each * times, slot + each
            base += times
        rows.sort()
        self.size, self.low, self.each, self.base, self.slot = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        self.key = self.size.astype(np.float64) * 2.0**40 + self.low

    def __call__(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, size.astype(np.float64) * 2.0**40 + rank, "right") - 1
        within = rank - self.low[at]
        return self.base[at] + within // self.each[at], self.slot[at] + within % self.each[at]


def _placed(slots: Slots, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, slot = slots(batch.column("size").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(slot)], names=[*names, "sequence_id", "slot"]
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    grain: int = GRAIN,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset (and ids)."""
    spark = docs.sparkSession
    staging = Staging(spark)
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    pieces = staging.keep(tokenized(docs, tokenizer, sequence, end_id, with_ids), "pieces")
    room, buckets = sequence // grain, 4 * partitions(spark)
    size = F.ceil(F.col("length") / grain).cast("int").alias("size")
    bucket = F.pmod(F.xxhash64(*KEYS, "start"), F.lit(buckets)).alias("bucket")
    items = pieces.withColumns({"size": size, "bucket": bucket})

    # Pieces per class and bucket: the rank of a piece is what lies in earlier buckets plus its place in its own.
    counts = staging.keep(items.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # one row per class
    if not histogram:
        return items.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("start").alias("sequence_id"), F.col("start").alias("offset"), *(["ids"] if with_ids else []))
    earlier = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    # One row per class and bucket, as many as there are partitions to fill: joined where the ranks are counted.
    place = F.row_number().over(Window.partitionBy("size", "bucket").orderBy(*KEYS, "start"))
    ranked = items.withColumn("place", place).join(before.hint("merge"), ["size", "bucket"])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*names, F.col("size").cast("long").alias("size"), (F.col("before") + F.col("place") - 1).alias("rank"))

    slots = Slots(plan(histogram, room))
    kinds = ", ".join(f"{n} {ranked.schema[n].dataType.simpleString()}" for n in names)
    placed = ranked.mapInArrow(_placed(slots, names), f"{kinds}, sequence_id long, slot long")
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
    return placed.select(*names[:5], "sequence_id", "offset", *names[5:])
