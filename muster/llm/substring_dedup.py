"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping blocks of half a window. A repeat of a whole window, however the two
copies lie to the blocks, holds a whole block of each copy. So it is enough to index every block and to probe the
index with every rolling window of a block's length:

1. Hashes of all rolling windows meet the blocks' hashes in buckets of the hash. A block whose words also start
   anywhere else is an anchor. Texts are
   folded some megabytes at a time and send a hash once, whatever its number, so that a passage in a third of all
   documents is one entry per slice; blocks that repeat inside a slice are anchors without asking.
2. Each anchor is extended to the windows that hold it, which are named by 96-bit hashes and grouped by content: equal
   windows meet under the smallest block hash they hold, neighbours mostly under the same one. All but the first
   occurrence, by document and start, are repeats; neighbouring repeats make up the maximal exact repeat. Inside a
   slice only the first occurrence goes on. Windows that share a block but differ in the words around it are not folded,
   so a phrase of many documents would take a run of each to one group: the windows of a block hash are counted, and
   above a bound they meet one by one under their own hash.
3. The words that repeats cover are removed.

Defined cases: a NULL or blank text has no words. Documents are ordered by doc_id, NULL last, then by a hash of the
text; rows that repeat a doc_id and text count as one document and get the same result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import KEYS, keyed, partitions
from muster.llm.rolling import buffers, runs, sliding_min, slices, window_hashes, word_hashes, words
from muster.plans.staging import Staging

WINDOW = 20
#: Texts of so many bytes are worked on at a time, and folded before they are sent.
_SLICE = 8 << 20
#: So many windows meet under one block hash at most; those of a more frequent one meet under their own hashes.
_MOST = 1 << 13


def _windows(data: np.ndarray, offsets: np.ndarray, size: int, seed: int, hashed=None):
    """Hash, text and place in the text of every window of ``size`` words."""
    starts, ends, text = words(data, offsets)
    first = np.searchsorted(text, np.arange(len(offsets) - 1))
    hashes = word_hashes(data, starts, ends, seed) if hashed is None else hashed
    whole = window_hashes(hashes, size, seed)
    inside = np.flatnonzero(text[: len(whole)] == text[size - 1 : size - 1 + len(whole)]) if len(whole) else np.zeros(0, np.int64)
    return whole[inside], text[inside], inside - first[text[inside]]


def _binary(values: np.ndarray, order: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The values of each bucket as bytes; ``order`` sorts by bucket, ``bounds`` are the buckets' ends."""
    raw = values[order].tobytes()
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32).tobytes()), pa.py_buffer(raw)]
    )


def _by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(bucket.astype(np.uint32), kind="stable")
    return order, np.r_[0, np.cumsum(np.bincount(bucket.astype(np.int64), minlength=buckets))]


_INDEX = "bucket int, probes binary, blocks binary, owners binary, numbers binary, sure_owners binary, sure_numbers binary"


def _probe(block: int, buckets: int):
    """For each slice and bucket: hashes of rolling windows, and of blocks with the document and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            keys = batch.column("k1").to_numpy()
            for a, b in slices(offsets, _SLICE):
                base = offsets[a]
                yield _indexed(_windows(data[base : offsets[b]], offsets[a : b + 1] - base, block, 1), keys[a:b], block, buckets)

    return run


def _indexed(windows: tuple, keys: np.ndarray, block: int, buckets: int) -> pa.RecordBatch:
    h, text, place = windows
    order = np.argsort(h)
    h, text, place = h[order], text[order], place[order]
    on_block, number = place % block == 0, (place // block).astype(np.uint32)
    first, length = runs(np.r_[True, h[1:] != h[:-1]][: len(h)])
    many = np.repeat(length > 1, length)
    sure, lone = on_block & many, on_block & ~many
    # A hash that occurs more than once is sent twice, any other once: as a block or as a probe.
    twice = first[length > 1]
    probes = np.concatenate([h[~on_block & ~many], h[twice], h[twice]])
    columns = [pa.array(range(buckets), pa.int32())]
    order, bounds = _by_bucket((probes >> np.uint64(32)) % np.uint64(buckets), buckets)
    columns.append(_binary(probes.astype(np.uint32), order, bounds))
    order, bounds = _by_bucket((h[lone] >> np.uint64(32)) % np.uint64(buckets), buckets)
    columns += [_binary(v, order, bounds) for v in (h[lone].astype(np.uint32), keys[text[lone]], number[lone])]
    owners = keys[text[sure]]
    order, bounds = _by_bucket(owners.view(np.uint64) % np.uint64(buckets), buckets)
    columns += [_binary(v, order, bounds) for v in (owners, number[sure])]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _INDEX.split(", ")])


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _anchors(table: pa.Table) -> pa.Table:
    """Blocks of one bucket whose hash occurs at least twice, by document."""
    blocks = _joined(table, "blocks", np.uint32)
    seen = np.sort(np.concatenate([_joined(table, "probes", np.uint32), blocks]))
    again = np.unique(seen[1:][seen[1:] == seen[:-1]])
    at = np.searchsorted(again, blocks)
    hit = (again[np.minimum(at, len(again) - 1)] == blocks) if len(again) else np.zeros(len(blocks), bool)
    owners = np.concatenate([_joined(table, "owners", np.int64)[hit], _joined(table, "sure_owners", np.int64)])
    numbers = np.concatenate([_joined(table, "numbers", np.uint32)[hit], _joined(table, "sure_numbers", np.uint32)])
    order = np.argsort(owners, kind="stable")
    owners, numbers = owners[order], numbers[order]
    first, length = runs(np.r_[True, owners[1:] != owners[:-1]][: len(owners)])
    lists = pa.ListArray.from_arrays(np.r_[first, len(owners)].astype(np.int32), pa.array(numbers.astype(np.int32)))
    return pa.table({"k1": owners[first], "numbers": lists if len(first) else pa.array([], pa.list_(pa.int32()))})


_RUNS = "meet long, order_id {kind}, k1 long, k2 long, start int, n int, high binary, low binary, sure boolean"


def _extend(window: int, block: int):
    """Anchors extended to the windows that hold them, as runs of neighbours that meet under one block hash. What is
    known to be a repeat inside the slice leaves as a sure run without hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            anchors = batch.column("numbers")
            for a, b in slices(offsets, _SLICE):
                base, ends = offsets[a], offsets[a : b + 1] - offsets[a]
                part = data[base : offsets[b]]
                starts, stops, text = words(part, ends)
                first = np.searchsorted(text, np.arange(b - a + 1))
                w1, w2 = word_hashes(part, starts, stops, 1), word_hashes(part, starts, stops, 2)
                # Word places under an anchor, then windows that hold a whole one.
                mark = np.zeros(len(starts) + window + 1, np.int64)
                for at in range(a, b):
                    numbers = np.unique(anchors[at].values.to_numpy(zero_copy_only=False)) * block + first[at - a]
                    mark[numbers[numbers + block <= first[at - a + 1]]] = 1
                before = np.r_[0, np.cumsum(mark)]
                n = max(0, len(starts) - window + 1)
                at = np.arange(n)
                good = (text[at] == text[at + window - 1]) & (before[at + window - block + 1] > before[at])
                at = np.flatnonzero(good)
                meet = sliding_min(window_hashes(w1, block, 1), window - block + 1)
                high, low = window_hashes(w1, window, 3)[at], window_hashes(w2, window, 4)[at].astype(np.uint32)
                yield from _first_of_slice(batch.slice(a, b - a), high, low, meet[at], text[at], at - first[text[at]])

    return run


def _first_of_slice(batch: pa.RecordBatch, high, low, meet, text, start) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _RUNS.split(", ")]
    if not len(high):
        return
    ranks = _rank(batch.column("order_id"), batch.column("k1").to_numpy())
    # Rows that repeat a doc_id and text get the same result: one of them speaks for all.
    one = np.zeros(len(ranks), bool)
    one[np.unique(ranks, return_index=True)[1]] = True
    high, low, meet, text, start = (c[one[text]] for c in (high, low, meet, text, start))
    rank = ranks[text]
    repeat = _repeats(high, low, rank, start)
    order = np.lexsort((start, text))
    high, low, meet, text, start, repeat = (c[order] for c in (high, low, meet, text, start, repeat))
    fresh = np.r_[True, (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1) | (repeat[1:] != repeat[:-1]) | (~repeat[1:] & (meet[1:] != meet[:-1]))]
    first, length = runs(fresh)
    sure = repeat[first]
    rows = pa.array(text[first])
    # A sure run has no hashes.
    sent = ~repeat
    ends = np.r_[0, np.cumsum(np.where(sure, 0, length))]
    whole = [None, pa.py_buffer((ends * 8).astype(np.int32).tobytes()), pa.py_buffer(high[sent].tobytes())]
    part = [None, pa.py_buffer((ends * 4).astype(np.int32).tobytes()), pa.py_buffer(low[sent].tobytes())]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.where(sure, 0, meet[first].view(np.int64))),
            *(batch.column(c).take(rows) for c in ("order_id", *KEYS)),
            pa.array(start[first].astype(np.int32)),
            pa.array(length.astype(np.int32)),
            pa.Array.from_buffers(pa.binary(), len(first), whole),
            pa.Array.from_buffers(pa.binary(), len(first), part),
            pa.array(sure),
        ],
        names=names,
    )


def _rank(ids: pa.Array, keys: np.ndarray) -> np.ndarray:
    """Place of each document by doc_id (NULL last), then key; equal ones share it."""
    none = ids.is_null().to_numpy(zero_copy_only=False)
    named = pa.compute.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
    order = np.lexsort((keys, named, none))
    fresh = np.r_[False, (named[order][1:] != named[order][:-1]) | (keys[order][1:] != keys[order][:-1])]
    out = np.zeros(len(keys), np.int64)
    out[order] = np.cumsum(fresh[: len(keys)])
    return out


def _repeats(high: np.ndarray, low: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows have an equal one that comes earlier."""
    order = np.lexsort((start, rank, low, high))
    high, low, rank, start = (c[order] for c in (high, low, rank, start))
    first, length = runs(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])][: len(high)])
    out = np.zeros(len(high), bool)
    out[order] = (rank != np.repeat(rank[first], length)) | (start != np.repeat(start[first], length))
    return out


def _dealt(asked: DataFrame, buckets: int, most: int, staging: Staging) -> DataFrame:
    """The runs with the bucket they meet in: that of their block hash, or where more than ``most`` windows have that
    hash, cut into single windows, that of the window's own hash. Equal windows share both hashes."""
    often = asked.groupBy("meet").agg(F.sum("n").alias("n")).where(F.col("n") > most).select("meet")
    often = staging.keep(often, "often")
    kept = ["order_id", *KEYS, "start", "high", "low"]

    def bucket(*columns: str):
        return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int").alias("bucket")

    runs_ = asked.join(often, "meet", "left_anti").select(bucket("meet"), *kept)
    each = asked.join(often, "meet", "left_semi").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    each = each.withColumns({
        "start": F.col("start") + F.col("i"),
        "high": F.substring("high", F.col("i") * 8 + 1, F.lit(8)),
        "low": F.substring("low", F.col("i") * 4 + 1, F.lit(4)),
    })
    return runs_.unionByName(each.select(bucket("high", "low"), *kept))


def _later(table: pa.Table) -> pa.Table:
    """Of the runs that meet in one bucket, the stretches of windows that have an earlier equal."""
    high, low = _joined(table, "high", np.uint64), _joined(table, "low", np.uint32)
    length = np.array([len(b) // 8 for b in table.column("high").to_pylist()], np.int64)
    ids, keys = table.column("order_id").combine_chunks(), table.column("k1").to_numpy()
    row = np.repeat(np.arange(len(length)), length)
    first = np.r_[0, np.cumsum(length)[:-1]]
    place = np.arange(len(high)) - first[row] if len(high) else np.zeros(0, np.int64)
    start = table.column("start").to_numpy()[row] + place
    repeat = _repeats(high, low, _rank(ids, keys)[row], start)
    at = np.flatnonzero(repeat)
    fresh = np.r_[True, (row[at][1:] != row[at][:-1]) | (at[1:] != at[:-1] + 1)][: len(at)]
    head, many = runs(fresh)
    return pa.table({
        "k1": keys[row[at[head]]],
        "k2": table.column("k2").to_numpy()[row[at[head]]],
        "start": pa.array(start[at[head]].astype(np.int32)),
        "n": pa.array(many.astype(np.int32)),
    })


def _removed(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests, texts = [], [], [], []
            lists = [batch.column(c).to_pylist() for c in ("k2", "at", "n", "of")]
            for value, k2, starts, counts, owners in zip(batch.column("text").cast(pa.binary()), *lists, strict=True):
                found = value.as_buffer().to_pybytes().split()
                n_words.append(len(found))
                if starts:
                    cover = np.zeros(len(found) + 1, np.int64)
                    mine = [(s, n) for s, n, o in zip(starts, counts, owners, strict=True) if o == k2]
                    begin = np.array([s for s, _ in mine], np.int64)
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, begin + [n + window - 1 for _, n in mine] if mine else begin, -1)
                    stays = np.flatnonzero(np.cumsum(cover)[:-1] == 0)
                    found = [found[i] for i in stays]
                n_removed.append(n_words[-1] - len(found))
                kept = b" ".join(found)
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode() if with_text else None)
            made = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", *KEYS, "n_words", "n_removed", "kept_sha256"]
            if with_text:
                made.append(pa.array(texts, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", *KEYS)), *made], names=names)

    return run


def drop_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False, most: int = _MOST) -> DataFrame:
    """doc_id, k1, k2, n_words, n_removed, kept_sha256 (and kept_text) of every row.

    A word goes when a window of ``window`` words that covers it also starts earlier, in a document with a smaller
    doc_id or before it in the same one.
    """
    spark, block = docs.sparkSession, window // 2
    buckets = 4 * partitions(spark)
    staging = Staging(spark)
    rows = keyed(docs).select("doc_id", "text", *KEYS)
    kind = rows.schema["doc_id"].dataType.simpleString()

    probes = rows.select("k1", "text").mapInArrow(_probe(block, buckets), _INDEX)
    anchors = probes.groupBy("bucket").applyInArrow(_anchors, "k1 long, numbers array<int>")
    # A document's anchors are at most its blocks.
    anchors = staging.keep(anchors.groupBy("k1").agg(F.flatten(F.collect_list("numbers")).alias("numbers")), "anchors")

    held = rows.hint("merge").join(anchors, "k1").withColumnRenamed("doc_id", "order_id")
    met = held.select("order_id", *KEYS, "text", "numbers").mapInArrow(_extend(window, block), _RUNS.format(kind=kind))
    met = staging.keep(met, "windows")
    dealt = _dealt(met.where("NOT sure"), buckets, most, staging)
    later = dealt.groupBy("bucket").applyInArrow(_later, "k1 long, k2 long, start int, n int")
    sure = met.where("sure").select(*KEYS, "start", "n")
    gone = later.unionByName(sure).groupBy("k1").agg(F.collect_list(F.struct("start", "n", "k2")).alias("gone"))
    marked = rows.hint("merge").join(gone, "k1", "left").select(
        "doc_id", *KEYS, "text", F.col("gone.start").alias("at"), F.col("gone.n").alias("n"), F.col("gone.k2").alias("of")
    )
    schema = f"doc_id {kind}, k1 long, k2 long, n_words long, n_removed long, kept_sha256 string"
    return marked.mapInArrow(_removed(window, with_text), schema + (", kept_text string" if with_text else ""))
