"""MinHash near-dedup by a multi-index Hamming join.

A document's set is its distinct word shingles. Documents of one set collapse to one node. A node's signature has
``CHUNKS * WIDTH`` places; a place holds ``BITS`` bits of the smallest value that one random function takes on the set,
so two sets differ in each place with a chance of about 1 - similarity.

Which pairs are looked at: the signature is split into chunks. A pair that differs in at most ``2 * CHUNKS - 1`` places
has, by the pigeonhole principle, a chunk with one error at most, and the allowed errors are enumerated: each chunk
gives a key for every place that may differ, made of its other places. So every pair under the signature distance
meets under some key, without loss. At similarity 0.85 a pair lies beyond that distance with a chance below 1e-6, and
even then it fails to meet under every key with a chance of 7e-11 only.

Only components are wanted, so nodes that meet are compared where they meet, and only links that join two parts leave
the task. Each key names one of its nodes, the first by a hash; all nodes of keys that name the same one form its group, so
two nodes that share a key share a group, and the many keys of close copies come to few groups. A group that is large in
members or bytes is cut into tiles and each pair of tiles is a group of its own. Inside a group

* a node without any other node within ``FAR`` differing places goes (the chance of that at the similarity asked is 1e-11);
* the full sets of the rest, made from their texts, decide: what a node shares with all others is counted from the
  group's inverted lists at once.

Nothing is capped.

Defined cases: a text with fewer words than a shingle is one shingle, its whole word sequence; a NULL or blank text has
an empty set, which is linked with nothing, not even with its copies. Rows that repeat a doc_id and text share their
component. The component of rows that have no doc_id at all is NULL, and ``kept`` is then false. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import KEYS, bitmap, in_bitmap, keep_one_each, keyed, partitions
from muster.llm.components import components
from muster.llm.rolling import buffers, mix, slices, window_hashes, word_hashes, words
from muster.plans.staging import Staging

CHUNKS, WIDTH, BITS = 13, 5, 16
#: A pair that differs in more places is not compared; pairs are sure to meet up to 2 * CHUNKS - 1.
FAR = 32
#: Nodes, and bytes of sets, that a tile of a group may hold.
TILE, TILE_BYTES = 1024, 8 << 20
_SLICE = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_WORD, _WINDOW, _FEW = 211, 223, 227
_PLACES = np.random.default_rng(12).integers(0, 1 << 62, CHUNKS * WIDTH, np.uint64) * np.uint64(4) + np.uint64(1)
_FACTORS = np.random.default_rng(13).integers(0, 1 << 62, WIDTH, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, sorted inside the text, and where each text's begin (one more at the end)."""
    data, n = _LOWER[data], len(offsets) - 1
    starts, ends, owner = words(data, offsets)
    hashes = word_hashes(data, starts, ends, _WORD)
    window = window_hashes(hashes, size, _WINDOW)
    inside = np.flatnonzero(owner[: len(window)] == owner[size - 1 :]) if len(window) else np.zeros(0, np.int64)
    window, mine = window[inside], owner[inside]
    # Texts of fewer words: the hash of the words they have, in order.
    count = np.bincount(owner, minlength=n)
    few = np.flatnonzero((count > 0) & (count < size))
    first = np.cumsum(count) - count
    short = np.full(len(few), _FEW, np.uint64)
    for at in range(size - 1):
        there = count[few] > at
        short[there] = mix(short[there] * np.uint64(0x9E3779B97F4A7C15) + hashes[first[few[there]] + at])
    window, mine = np.concatenate([window, short]), np.concatenate([mine, few])
    order = np.lexsort((window, mine))
    window, mine = window[order], mine[order]
    fresh = np.ones(len(window), bool)
    fresh[1:] = (window[1:] != window[:-1]) | (mine[1:] != mine[:-1])
    return window[fresh], np.r_[0, np.cumsum(np.bincount(mine[fresh], minlength=n))]


def signatures(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of 16-bit places for each set (none may be empty)."""
    out = np.zeros((len(starts) - 1, len(_PLACES)), np.uint16)
    if len(out):
        for at, factor in enumerate(_PLACES):
            low = np.minimum.reduceat(sets * factor, starts[:-1])  # the values are hashes already
            out[:, at] = (mix(low) & np.uint64((1 << BITS) - 1)).astype(np.uint16)
    return out


def keys_of(signature: np.ndarray) -> np.ndarray:
    """Of each signature, a key for every chunk and place in it that may differ: (rows, CHUNKS * WIDTH)."""
    places = signature.reshape(len(signature), CHUNKS, WIDTH).astype(np.uint64) + np.uint64(1)
    salted = mix(places * _FACTORS + np.arange(CHUNKS, dtype=np.uint64)[None, :, None])
    total = salted.sum(axis=2, dtype=np.uint64)
    # The place left out is part of the key, as is the chunk.
    left_out = total[:, :, None] - salted + _FACTORS[None, None, :]
    return mix(left_out.reshape(len(signature), CHUNKS * WIDTH))


def _set_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for low, high in slices(offsets, _SLICE):
                base = offsets[low]
                sets, starts = shingle_sets(data[base : offsets[high]], offsets[low : high + 1] - base, size)
                count = np.diff(starts)
                full = np.flatnonzero(count)
                at = starts[:-1][full]
                digests = np.zeros((2, len(count)), np.int64)
                marks: list[bytes | None] = [None] * len(count)
                if len(full):
                    for i, salt in enumerate((0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)):
                        digests[i, full] = mix(np.add.reduceat(mix(sets * np.uint64(salt)), at)).view(np.int64)
                    edges = np.r_[at, len(sets)]
                    for i, row in zip(full.tolist(), signatures(sets, edges), strict=True):
                        marks[i] = row.tobytes()
                columns = [batch.column(c).slice(low, high - low) for c in ("doc_id", *KEYS)]
                made = [pa.array(count, pa.int64()), pa.array(digests[0]), pa.array(digests[1]), pa.array(marks, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, *made], names=["doc_id", *KEYS, "n", "s1", "s2", "signature"])

    return run


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    each = CHUNKS * WIDTH
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            places = np.frombuffer(b"".join(part.column("signature").to_pylist()), "<u2").reshape(-1, each)
            node = part.column("node").to_numpy()
            rank = mix(node.astype(np.uint64) + np.uint64(1)).view(np.int64)
            columns = [keys_of(places).view(np.int64).ravel(), np.repeat(rank, each), np.repeat(node, each)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "rank", "node"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(one, node) for the nodes of each key that several have, ``one`` being the first; rows come sorted by key and
    rank. No more of a key is held than its first row."""
    key, one, open_ = None, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, nodes = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        fresh = np.r_[key is None or keys[0] != key, keys[1:] != keys[:-1]]
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), -1))
        ones = np.where(head < 0, one, nodes[head])
        left, right = [ones[~fresh]], [nodes[~fresh]]
        # The first row of a key is told with the second.
        second = np.flatnonzero(~fresh & np.r_[open_, fresh[:-1]])
        left.append(ones[second])
        right.append(ones[second])
        open_ = bool(fresh[-1])
        key, one = keys[-1], ones[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (left, right)], names=["one", "node"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by (one, tile), cut between groups."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        by = np.column_stack([batch.column(c).to_numpy() for c in ("one", "tile")])
        cuts = (np.flatnonzero((by[1:] != by[:-1]).any(axis=1)) + 1).tolist()
        if last is not None and (by[0] != last).any():
            cuts = [0, *cuts]
        for low, high in zip([0, *cuts], [*cuts, len(by)], strict=True):
            if low in cuts and held:
                yield pa.concat_batches(held)
                held = []
            if high > low:
                held.append(batch.slice(low, high - low))
        last = by[-1]
    if held:
        yield pa.concat_batches(held)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a group that have another one within ``FAR`` places."""
    for group in _groups(batches):
        places = np.frombuffer(b"".join(group.column("signature").to_pylist()), "<u2").reshape(group.num_rows, -1)
        near = np.zeros(group.num_rows, bool)
        for at in range(group.num_rows):
            if not near[at]:
                hit = (places != places[at]).sum(axis=1) <= FAR
                near |= hit if hit.sum() > 1 else False
        rows = group.filter(pa.array(near))
        names = ["one", "tile", "node", *KEYS]
        yield pa.RecordBatch.from_arrays([rows.column(c) for c in names], names=names)


def linked_sets(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that span the components among the sets."""
    root = np.arange(len(sets))
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    values, owner = flat[order], owner[order]
    # Where the inverted list of each member's hashes begins, and how long it is.
    low = np.searchsorted(values, flat)
    many = np.searchsorted(values, flat, "right") - low
    edges = np.r_[0, np.cumsum(size)]
    out = []
    for at in range(len(sets) - 1):
        rest = root[at + 1 :] != root[at]
        if not rest.any():
            continue
        first, length = low[edges[at] : edges[at + 1]], many[edges[at] : edges[at + 1]]
        first, length = first[length > 1], length[length > 1]
        total = int(length.sum())
        within = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
        common = np.bincount(owner[np.repeat(first, length) + within], minlength=len(sets))
        hit = at + 1 + np.flatnonzero(rest & (den * common[at + 1 :] >= num * (size[at] + size[at + 1 :] - common[at + 1 :])))
        for other in hit.tolist():
            if root[other] != root[at]:
                out.append((at, other))
                root[root == root[other]] = root[at]
    return out


def _links(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if group.num_rows > 1:
                node = group.column("node").to_numpy()
                sets = [np.frombuffer(raw.as_buffer(), "<u8") for raw in group.column("set")]
                found = np.array(linked_sets(sets, num, den), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(node[found[:, i]]) for i in (0, 1)], names=["a", "b"])

    return run


def _texts_to_sets(size: int, wanted: np.ndarray):
    """Sets of the texts whose key the bitmap names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(wanted, batch.column("k1").to_numpy())))
            data, offsets = buffers(batch.column("text"))
            for low, high in slices(offsets, _SLICE):
                base = offsets[low]
                sets, starts = shingle_sets(data[base : offsets[high]], offsets[low : high + 1] - base, size)
                raw = [sets[s:e].astype("<u8").tobytes() for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                keys = [batch.column(c).slice(low, high - low) for c in KEYS]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(raw, pa.binary())], names=[*KEYS, "set"])

    return run


def _nodes(rows: DataFrame) -> DataFrame:
    """One row for each distinct set, with one text to make it from."""
    head = F.min(F.struct(*KEYS)).alias("head")
    nodes = rows.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("signature").alias("signature"), head)
    # The id is written with the row, so it is the same for every reader.
    return nodes.select(F.monotonically_increasing_id().alias("node"), "s1", "s2", "low", "n", "signature", "head.k1", "head.k2")


def _tiled(met: DataFrame, sizes: DataFrame, staging: Staging, tile: int, tile_bytes: int) -> DataFrame:
    """one, tile, node: the members of each group, a large one in pairs of tiles."""
    sized = staging.keep(met.join(sizes, "node"), "sized")
    load = sized.groupBy("one").agg(F.count(F.lit(1)).alias("m"), F.sum(8 * F.col("n")).alias("bytes"))
    tiles = F.greatest(F.ceil(F.col("m") / tile), F.ceil(F.col("bytes") / tile_bytes)).cast("int").alias("tiles")
    load = staging.keep(load.select("one", tiles), "load")
    mine = F.pmod(F.xxhash64("node"), "tiles").cast("int").alias("mine")
    cut = sized.join(load, "one").select("one", "node", "tiles", mine, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    return cut.select("one", (F.least("mine", "other").cast("long") * F.col("tiles") + F.greatest("mine", "other")).alias("tile"), "node")


def links(rows: DataFrame, texts: DataFrame, nodes: DataFrame, staging: Staging, size: int, num: int, den: int, tile: int, tile_bytes: int) -> DataFrame:
    """Confirmed links (a, b) that span the components among the nodes."""
    n = partitions(rows.sparkSession)
    keys = nodes.select("node", "signature").mapInArrow(_key_batches, "key long, rank long, node long")
    spread = keys.repartition(n, "key").sortWithinPartitions("key", "rank")
    met = staging.keep(spread.mapInArrow(_met, "one long, node long").distinct(), "met")
    dealt = staging.keep(_tiled(met, nodes.select("node", "n"), staging, tile, tile_bytes), "dealt")
    marked = dealt.join(nodes.select("node", "signature", *KEYS), "node").repartition(n, "one", "tile").sortWithinPartitions("one", "tile")
    near = staging.keep(marked.mapInArrow(_near, "one long, tile long, node long, k1 long, k2 long"), "near")
    made = texts.mapInArrow(_texts_to_sets(size, bitmap(near.select("k1").distinct(), "k1")), "k1 long, k2 long, set binary")
    # Rows that agree in doc_id and text share their key; one of them is enough. The sets are by far the widest rows: they
    # are dealt twice, by their key and by group, whichever side of a join Spark may broadcast.
    sets = made.groupBy(*KEYS).agg(F.first("set").alias("set"))
    full = near.join(sets, KEYS).repartition(n, "one", "tile").sortWithinPartitions("one", "tile")
    return full.select("one", "tile", "node", "set").mapInArrow(_links(num, den), "a long, b long").distinct()


def near_sets(docs: DataFrame, size: int = 3, num: int = 85, den: int = 100, tile: int = TILE, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """One row per document: doc_id, k1, k2, n_shingles, root (of the component's nodes, NULL for an empty set),
    component_id (its smallest doc_id) and kept. Sets link when ``den`` times what they share is at least ``num`` times
    what they hold together."""
    staging, texts = Staging(docs.sparkSession), keyed(docs)
    made = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, k1 long, k2 long, n long, s1 long, s2 long, signature binary"
    every = staging.keep(texts.select("doc_id", *KEYS, "text").mapInArrow(_set_batches(size), made), "rows")
    nodes = staging.keep(_nodes(every), "nodes")
    found = links(every, texts.select(*KEYS, "text"), nodes, staging, size, num, den, tile, tile_bytes)
    roots = components(found, staging)
    rooted = nodes.join(roots, "node", "left").select("s1", "s2", "low", F.coalesce("root", "node").alias("root"))
    rooted = staging.keep(rooted, "rooted")
    lows = staging.keep(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    known = staging.keep(rooted.join(lows, "root").select("s1", "s2", "root", "component_id"), "known")
    rows = every.select("doc_id", *KEYS, F.col("n").alias("n_shingles"), "s1", "s2")
    full = rows.where("n_shingles > 0").join(known, ["s1", "s2"])
    empty = rows.where("n_shingles = 0").withColumn("root", F.lit(None).cast("long")).withColumn("component_id", F.col("doc_id"))
    both = full.unionByName(empty, allowMissingColumns=True)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return both.select("doc_id", *KEYS, "n_shingles", "root", "component_id", kept.alias("kept"))


def drop_near_sets(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The row with the smallest doc_id of each component (NULL last) and every row without words, with all columns."""
    groups = near_sets(docs, size, num, den)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEYS)
    heads = groups.where("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("head")).select("head.k1", "head.k2")
    return keep_one_each(docs, heads.unionByName(groups.where("root IS NULL").select(*KEYS).distinct()))
