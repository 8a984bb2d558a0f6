"""SimHash near-dedup with pivot distance tables.

A document's fingerprint takes each bit by majority over the XXH64 values of its word shingles. Documents with one
fingerprint collapse to one node at once. Two fingerprints link when they differ in few bits; components of links
are the near-duplicate groups.

Which pairs are looked at: 64 bits are cut into blocks, and a pair with at most ``max_bits`` differing bits agrees in
at least ``blocks - max_bits`` whole blocks. Every choice of so many blocks is a table keyed by their bits, so each
linked pair meets under some key, without loss. Pivots alone cannot enumerate pairs (the distances of random
fingerprints to any reference lie close together), so they decide inside a key:

* the Hamming distances to many reference fingerprints are computed once per fingerprint that shares a key;
* by the triangle inequality a pair whose distances to any pivot differ by more than ``max_bits`` cannot link;
* the survivors are verified by their differing bits.

Inside a key only spanning links leave the task (a walk that takes each fingerprint once), never all pairs. Keys
with very many fingerprints are cut into tiles and each pair of tiles is a group of its own.

Defined cases: a NULL or blank text has fingerprint zero and links like any other; the component of rows that have no
doc_id at all is NULL; rows that repeat a doc_id and text share fingerprint and component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import KEYS, keep_one_each, keyed, partitions
from muster.llm.components import components
from muster.plans.staging import Staging

SEED = 42
BLOCKS = 7
PIVOTS = 24
#: Fingerprints under one key that one group may hold; beyond it the key is cut into tiles.
TILE = 20_000
_SMALL = 8
_SEGMENT = 1 << 20


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, a bounded list at a time."""
    at = 0
    while at < len(data):
        end = at + _SEGMENT
        # A word is never cut: go on to the next white space.
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes, shingle: int) -> int:
    """Majority bits of the shingles' XXH64; zero without words."""
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    ones, total, held = np.zeros(64, np.int64), 0, []
    for words in words_of(data.lower()):
        words = held + words
        held = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts, ends = (ends - lengths).tolist(), ends[shingle - 1 :].tolist()
        hashes = np.fromiter((digest(joined[s:e]) for s, e in zip(starts, ends, strict=False)), "<u8", len(ends))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
    if not total:
        return digest(b" ".join(held)) if held else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _print_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column("text").cast(pa.binary())]
            prints = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", *KEYS)), prints], names=["doc_id", *KEYS, "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, k1, k2 and print (the 64 bits as a long) of every row."""
    rows = keyed(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", *KEYS, "text").mapInArrow(_print_batches(shingle), f"doc_id {kind}, k1 long, k2 long, print long")


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """One 64-bit mask for each choice of ``blocks - max_bits`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def pivot_table(prints: np.ndarray, pivots: int) -> np.ndarray:
    """Hamming distance of every fingerprint to every reference fingerprint."""
    references = np.random.default_rng(SEED).integers(0, 1 << 64, pivots, np.uint64, endpoint=False)
    return np.bitwise_count(prints[:, None] ^ references[None, :]).astype(np.int8)


def _verified(bits: np.ndarray, gaps: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs link, from their differing ``bits`` and the ``gaps`` of their pivot distances: any gap above
    ``max_bits`` discards a pair, the bits decide about the survivors."""
    near = np.flatnonzero((np.abs(gaps) <= max_bits).all(axis=1))
    return near[np.bitwise_count(bits[near]) <= max_bits]


def spanning_links(prints: np.ndarray, max_bits: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components among distinct fingerprints; each is taken from the open set once."""
    table = pivot_table(prints, pivots)
    by_first = np.argsort(table[:, 0], kind="stable")
    prints, table = prints[by_first], table[by_first]
    first, open_ = table[:, 0], np.ones(len(prints), bool)
    left, right = [], []
    for start in range(len(prints)):
        if not open_[start]:
            continue
        open_[start], queue = False, [start]
        while queue:
            at = queue.pop()
            lo = np.searchsorted(first, first[at] - max_bits)
            hi = np.searchsorted(first, first[at] + max_bits, "right")
            among = lo + np.flatnonzero(open_[lo:hi])
            hit = among[_verified(prints[among] ^ prints[at], table[among] - table[at], max_bits)]
            open_[hit] = False
            queue += hit.tolist()
            left.append(np.full(len(hit), prints[at]))
            right.append(prints[hit])
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _links_of_sorted(max_bits: int, pivots: int):
    """Links among rows (kind, key, tile, print) that come sorted by the first three."""

    def links(group: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
        sizes = np.diff(np.r_[starts, len(group)])
        lone = np.repeat(sizes == 1, sizes)
        left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        # Small groups: rows against those a fixed distance further on, all groups at once.
        within = np.flatnonzero(~lone & np.repeat(sizes <= _SMALL, sizes))
        table = pivot_table(prints[within], pivots)
        for step in range(1, _SMALL):
            pair = np.flatnonzero(group[within[step:]] == group[within[:-step]]) if len(within) > step else within[:0]
            a, b = within[pair], within[pair + step]
            hit = _verified(prints[a] ^ prints[b], table[pair] - table[pair + step], max_bits)
            left.append(prints[a[hit]])
            right.append(prints[b[hit]])
        for start, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
            a, b = spanning_links(np.unique(prints[start : start + size]), max_bits, pivots)
            left.append(a)
            right.append(b)
        pairs = np.stack([np.concatenate(left), np.concatenate(right)], axis=1)
        pairs = np.unique(pairs, axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("kind", "key", "tile")], axis=1)
            rows = np.column_stack([keys, batch.column("print").to_numpy()])
            if held:
                rows = np.concatenate([*held, rows])
            last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0  # the last group may go on in the next batch
            if cut:
                yield links(_numbered(rows[:cut]), rows[:cut, 3].astype(np.int64).view(np.uint64))
            held = [rows[cut:]]
        if held and len(held[0]):
            yield links(_numbered(held[0]), np.ascontiguousarray(held[0][:, 3]).view(np.uint64))

    return run


def _numbered(rows: np.ndarray) -> np.ndarray:
    return np.cumsum(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])


def links(nodes: DataFrame, staging: Staging, max_bits: int, blocks: int = BLOCKS, pivots: int = PIVOTS, tile: int = TILE) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``print`` that differ in at most ``max_bits`` bits."""
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in block_masks(max_bits, blocks)]
    # All keys of a print that pass: a mask for each kind, as one array expression.
    keyed_rows = nodes.select(
        "print", F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(m)) for m in masks])).alias("kind", "key")
    )
    crowded = staging.keep(
        keyed_rows.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile), "crowded"
    )
    rows = keyed_rows.withColumn("tile", F.lit(0))
    if not crowded.isEmpty():
        # Tiles of a crowded key: each print goes to the pairs of its own tile with every tile.
        cut = rows.drop("tile").join(crowded, ["kind", "key"])
        tiles = F.ceil(F.col("n") / tile).cast("int")
        mine = F.pmod(F.xxhash64("print"), tiles).cast("int")
        other = F.explode(F.sequence(F.lit(0), tiles - 1))
        cut = cut.select("kind", "key", "print", "n", mine.alias("mine"), other.alias("other"))
        low, high = F.least("mine", "other"), F.greatest("mine", "other")
        cut = cut.select("kind", "key", "print", (low * F.ceil(F.col("n") / tile) + high + 1).cast("int").alias("tile"))
        rows = rows.join(crowded.select("kind", "key"), ["kind", "key"], "left_anti").unionByName(cut)
    spread = rows.repartition(partitions(nodes.sparkSession), "kind", "key", "tile").sortWithinPartitions("kind", "key", "tile")
    found = spread.select("kind", "key", "tile", "print").mapInArrow(_links_of_sorted(max_bits, pivots), "a long, b long")
    return found.distinct()


def near_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int = BLOCKS, pivots: int = PIVOTS, tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, k1, k2, print, root (of the component's prints) and component_id, its smallest doc_id."""
    staging = Staging(docs.sparkSession)
    prints = staging.keep(fingerprints(docs, shingle), "prints")
    nodes = staging.keep(prints.groupBy("print").agg(F.min("doc_id").alias("low")), "nodes")
    roots = components(links(nodes.select("print"), staging, max_bits, blocks, pivots, tile), staging)
    rooted = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "low", F.coalesce("root", "print").alias("root")
    )
    # Written, so that the join shares no partitioning with the fold and a component with very many prints can be split.
    lows = staging.keep(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    known = rooted.join(lows, "root").select("print", "root", "component_id")
    return prints.join(known, "print").select("doc_id", *KEYS, "print", "root", "component_id")


def hex_print(column: str = "print"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def drop_near_copies(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The row with the smallest doc_id of each group (NULL last), with all its columns."""
    groups = near_groups(docs, shingle, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEYS)
    heads = groups.groupBy("root").agg(F.min(order).alias("head"))
    return keep_one_each(docs, heads.select("head.k1", "head.k2"))
