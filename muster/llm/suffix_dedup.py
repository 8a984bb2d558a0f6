"""Removal of repeated byte strings by suffix arrays.

What has to be compared is found first, without loss: every window of ``window`` bytes holds a smallest hash among
its short grams, and equal windows hold the same one. Neighbouring windows with the same smallest gram are a fragment.
Only grams that occur more than once in the corpus can hide a repeat; their fragments are dealt to shards by gram, so
equal windows meet in one shard. In each shard

* the suffix array of its fragments is built by Larsson-Sadakane refinement,
* Kasai's walk gives the common prefixes of neighbours in it,
* a stretch of suffixes with common prefixes of a whole window is a class of equal windows; two or more are repeats.

A gram with very many fragments is spread over several shards. There the classes are merged across the gram's shards:
each shard's sorted list of window digests is looked up in the merged list of all by binary search.

Equal fragments of one Arrow batch are repeats without asking; one of them goes on for the others to meet, so that a
passage in a third of all documents is one fragment per batch.

Defined cases: a NULL text is empty. Every row is a document; rows that repeat a doc_id and text are copies of each
other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import KEYS, keyed, partitions
from muster.llm.rolling import SEGMENT, buffers, mix, runs, sliding_min, slices, stream, window_hashes
from muster.llm.suffix_arrays import common_prefixes, suffix_array
from muster.plans.staging import Staging

WINDOW = 400
GRAM = 32
#: Windows of one fragment; longer ones (a text of one repeated gram) are cut.
FRAGMENT = 4096
#: Fragments of one gram that a shard takes; a gram with more is spread.
SPREAD = 8192
_PART = 60_000
_SLICE = 4 << 20


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    return window_hashes(stream(11).table[data], gram, 11)


def fragments(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """For each fragment of the texts: text, first window, number of windows, gram, and the gram's places in it."""
    marks = np.zeros(len(data) + 1, np.int32)
    size = np.diff(offsets)
    # Windows that would leave their text, and the first window of each text.
    long = size >= window
    np.add.at(marks, np.where(long, offsets[1:] - window + 1, offsets[:-1]), 1)
    np.add.at(marks, offsets[1:], -1)
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    first, key, place = [], [], []
    total, outside = len(data) - window + 1, 0
    for at in range(0, max(total, 0), _PART):
        part = data[at : at + _PART + window - 1]
        hashes = _grams(part, gram)
        # 48 bits of the hash, then the place: the leftmost smallest gram.
        packed = (hashes & np.uint64(0xFFFFFFFFFFFF0000)) | np.arange(len(hashes), dtype=np.uint64)
        where = (sliding_min(packed, window - gram + 1) & np.uint64(0xFFFF)).astype(np.int64)
        n = len(where)
        out = np.cumsum(marks[at : at + n]) + outside
        outside = int(out[-1])
        fresh = np.r_[True, where[1:] != where[:-1]] | begins[at : at + n]
        fresh |= np.r_[False, (out[1:] > 0) != (out[:-1] > 0)]
        heads = np.flatnonzero(fresh)
        inside = out[heads] == 0
        first.append(np.where(inside, heads + at, -1 - (heads + at)))
        key.append(hashes[where[heads]])
        place.append(where[heads] + at)
    if not first:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    start, key, place = (np.concatenate(c) for c in (first, key, place))
    inside = start >= 0
    begin = np.where(inside, start, -1 - start)
    length = np.diff(np.r_[begin, total])
    text = np.searchsorted(offsets, begin, "right") - 1
    # Neighbours under the same gram are one fragment; a place seen before (at a cut) is not counted again.
    joins = np.r_[False, (key[1:] == key[:-1]) & (text[1:] == text[:-1]) & inside[1:] & inside[:-1]]
    again = joins & np.r_[False, place[1:] == place[:-1]]
    head = np.flatnonzero(~joins)
    windows = np.add.reduceat(length, head)
    places = np.add.reduceat((~again).astype(np.int64), head)
    good = inside[head]
    head, windows, places = head[good], windows[good], places[good]
    return text[head], begin[head] - offsets[text[head]], windows, key[head], places


def _all_fragments(batch: pa.RecordBatch, window: int, gram: int) -> Iterator[tuple]:
    data, offsets = buffers(batch.column("text"))
    for a, b in slices(offsets, _SLICE):
        base = offsets[a]
        found = fragments(data[base : offsets[b]], offsets[a : b + 1] - base, window, gram)
        yield a, data, offsets, found


def _count(window: int, gram: int):
    """(gram, k1, places) for each document: where the smallest grams of its windows are, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("k1").to_numpy()
            for a, _, _, (text, _, _, key, places) in _all_fragments(batch, window, gram):
                order = np.lexsort((key, text))
                text, key, places = text[order], key[order], places[order]
                first, _ = runs(np.r_[True, (text[1:] != text[:-1]) | (key[1:] != key[:-1])][: len(text)])
                n = np.add.reduceat(places, first) if len(first) else places
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[first].view(np.int64)), pa.array(keys[text[first] + a]), pa.array(n.astype(np.int64))],
                    names=["gram", "k1", "n"],
                )

    return run


_ASKED = "shard int, spread boolean, k1 long, k2 long, start long, n int, weight int, bytes binary"


def _cut(window: int, gram: int, shards: int):
    """The fragments of repeated grams with their bytes; equal ones of a batch once, the others as sure (weight 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, spreads = batch.column("grams"), batch.column("spreads")
            rows: dict[bytes, list] = {}
            sure = []
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for a, data, offsets, (text, start, n, key, _) in _all_fragments(batch, window, gram):
                bounds = np.searchsorted(text, np.arange(text[-1] + 2)) if len(text) else np.zeros(1, np.int64)
                for at in range(len(bounds) - 1):
                    low, high = bounds[at], bounds[at + 1]
                    if low == high:
                        continue
                    mine = wanted[a + at].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    spread = spreads[a + at].values.to_numpy(zero_copy_only=False)
                    order = np.argsort(mine)
                    mine, spread = mine[order], spread[order]
                    found = np.minimum(np.searchsorted(mine, key[low:high]), len(mine) - 1)
                    for i in np.flatnonzero(mine[found] == key[low:high]).tolist():
                        ways = int(spread[found[i]])
                        for piece in range(0, int(n[low + i]), FRAGMENT):
                            begin, many = int(start[low + i]) + piece, min(FRAGMENT, int(n[low + i]) - piece)
                            body = data[offsets[a + at] + begin : offsets[a + at] + begin + many + window - 1].tobytes()
                            mark = key[low + i].tobytes() + body
                            owner = (k1[a + at], k2[a + at], begin, many)
                            known = rows.get(mark)
                            if known is None:
                                rows[mark] = [owner, 1, ways, body]
                            else:
                                known[1] = 2
                                sure.append(owner)
            made = []
            for mark, (owner, weight, ways, body) in rows.items():
                at = int.from_bytes(mark[:8], "little") + (zlib.crc32(body) % ways if ways > 1 else 0)
                made.append((at & (1 << 64) - 1, ways > 1, *owner, weight, body))
            made += [(owner[0] & (1 << 64) - 1, False, *owner, 0, None) for owner in sure]
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*made, strict=True)) if made else [[]] * 8
            columns[0] = (mix(np.array(columns[0], np.uint64)) % np.uint64(shards)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _ASKED.split(", ")]
            )

    return run


_FOUND = "k1 long, k2 long, start long, n int, d1 long, d2 long, shard int"


def equal_windows(data: np.ndarray, owned: np.ndarray, weight: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of equal windows among the positions ``owned`` of a shard's bytes: those positions in sorted order, and
    where each class starts. ``weight`` is not looked at; it is the caller's to sum."""
    order, place = suffix_array(data, window)
    shared = common_prefixes(data, order, place, window)
    fresh = shared < window
    group = np.cumsum(fresh)
    mine = owned[order]
    positions, group = order[mine].astype(np.int64), group[mine]
    return positions, np.r_[True, group[1:] != group[:-1]][: len(positions)]


def _shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        k1, k2, start, n, weight = (table.column(c).to_numpy() for c in ("k1", "k2", "start", "n", "weight"))
        spread = table.column("spread").to_numpy(zero_copy_only=False).astype(bool)
        sure = np.flatnonzero(weight == 0)
        out = [(k1[sure], k2[sure], start[sure], n[sure], np.zeros(len(sure), np.int64), np.zeros(len(sure), np.int64), np.full(len(sure), -1))]
        asked = np.flatnonzero(weight > 0)
        if len(asked):
            out += _asked(table, asked, (k1, k2, start, n, weight, spread), window)
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int64, np.int64, np.int32)
        return pa.table([pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _FOUND.split(", ")])

    return run


def _asked(table: pa.Table, asked: np.ndarray, facts: tuple, window: int) -> list[tuple]:
    k1, k2, start, n, weight, spread = facts
    # Equal fragments of several batches are one, with the weight of all.
    bodies: dict[bytes, int] = {}
    texts = table.column("bytes").take(pa.array(asked)).to_pylist()
    which = np.array([bodies.setdefault(t, len(bodies)) for t in texts])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(b) for b in bodies], np.int64)
    base = np.r_[0, np.cumsum(sizes)]
    weights = np.bincount(which, weights=weight[asked], minlength=len(bodies)).astype(np.int64)
    wide = np.zeros(len(bodies), bool)
    wide[which[spread[asked]]] = True
    fragment = np.repeat(np.arange(len(bodies)), sizes)
    owned = np.arange(len(data)) - base[fragment] <= sizes[fragment] - window
    positions, fresh = equal_windows(data, owned, weights, window)
    first, length = runs(fresh)
    total = np.add.reduceat(weights[fragment[positions]], first)
    again = np.zeros(len(data), bool)
    again[positions] = np.repeat(total > 1, length)
    out = []
    # Stretches of repeated windows of each fragment, for each of its owners.
    edge = np.r_[True, (again[1:] != again[:-1]) | (fragment[1:] != fragment[:-1])]
    head, many = runs(edge)
    keep = again[head]
    head, many = head[keep], many[keep]
    by_body = np.argsort(which, kind="stable")
    counts = np.bincount(which, minlength=len(bodies))
    ends = np.r_[0, np.cumsum(counts)]

    def owners_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each position the rows of the table that own its fragment, and which position each is for."""
        f = fragment[at]
        repeat = counts[f]
        index = np.repeat(np.arange(len(at)), repeat)
        within = np.arange(len(index)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        return asked[by_body[ends[f[index]] + within]], index

    row, index = owners_of(head)
    at = head[index]
    none = np.zeros(len(row), np.int64)
    out.append((k1[row], k2[row], start[row] + at - base[fragment[at]], many[index], none, none, np.full(len(row), -1)))
    if wide.any():
        # One window of each class of a spread gram, with its digest; a class that is settled tells the other shards.
        chosen = positions[first]
        settled = total > 1
        chosen, settled = chosen[wide[fragment[chosen]]], settled[wide[fragment[chosen]]]
        digests = [window_hashes(stream(s).table[data], window, s).view(np.int64) for s in (21, 22)]
        row, index = owners_of(chosen)
        lone = np.r_[True, index[1:] != index[:-1]][: len(index)]  # an unsettled class has one owner
        row, index = row[lone], index[lone]
        at = chosen[index]
        # A shard of its own number: fragments of a gram's shards never share one.
        tag = np.where(settled[index], 1, 0)
        out.append((k1[row], k2[row], start[row] + at - base[fragment[at]], -1 - tag, digests[0][at], digests[1][at], np.full(len(row), int(table.column("shard")[0].as_py()))))
    return out


def _merge(table: pa.Table) -> pa.Table:
    """Windows of one digest bucket that another shard holds too: each shard's sorted list is searched in all others'."""
    d1, d2, shard, n = (table.column(c).to_numpy() for c in ("d1", "d2", "shard", "n"))
    order = np.lexsort((d2, d1))
    first, length = runs(np.r_[True, (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])][: len(order)])
    label = np.zeros(len(order), np.int64)
    label[order] = np.repeat(np.arange(len(first)), length)  # the digests' ranks in the merged list
    lists = {s: np.sort(label[shard == s]) for s in np.unique(shard)}
    hit = np.zeros(len(order), bool)
    merged = np.sort(label)
    for s, mine in lists.items():
        at = np.flatnonzero((shard == s) & (n == -1))
        here = np.searchsorted(mine, label[at], "right") - np.searchsorted(mine, label[at])
        everywhere = np.searchsorted(merged, label[at], "right") - np.searchsorted(merged, label[at])
        hit[at] = everywhere > here
    rows = pa.array(np.flatnonzero(hit))
    return pa.table([*(table.column(c).take(rows) for c in ("k1", "k2", "start")), pa.array(np.ones(len(rows), np.int32))], names=["k1", "k2", "start", "n"])


def _removed(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            lists = [batch.column(c).to_pylist() for c in ("k2", "at", "n", "of")]
            for value, k2, starts, counts, owners in zip(batch.column("text").cast(pa.binary()), *lists, strict=True):
                body = value.as_buffer().to_pybytes()
                kept, spans = [], 0
                mine = sorted((s, s + c - 1 + window) for s, c, o in zip(starts or [], counts or [], owners or [], strict=True) if o == k2)
                done, last = 0, -1
                for begin, end in mine:
                    if begin > last:
                        spans += 1
                        kept.append(body[done:begin])
                    done = last = max(last, end)
                kept.append(body[done:])
                left = b"".join(kept)
                made.append((len(body), len(body) - len(left), spans, hashlib.sha256(left).hexdigest(), left if with_text else None))
            columns = list(zip(*made, strict=True)) if made else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"][: 5 if with_text else 4]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", *KEYS)), *(pa.array(columns[i], kinds[i]) for i in range(len(names)))],
                names=["doc_id", *KEYS, *names],
            )

    return run


def drop_repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, spread: int = SPREAD, with_text: bool = False) -> DataFrame:
    """doc_id, k1, k2, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes) of every row.

    A byte goes when a string of ``window`` bytes that covers it also starts anywhere else.
    """
    spark = docs.sparkSession
    shards = 8 * partitions(spark)
    staging = Staging(spark)
    rows = keyed(docs).select("doc_id", "text", *KEYS)
    kind = rows.schema["doc_id"].dataType.simpleString()

    held = staging.keep(rows.select("k1", "text").mapInArrow(_count(window, gram), "gram long, k1 long, n long"), "grams")
    often = held.groupBy("gram").agg(F.sum("n").alias("times")).where("times > 1")
    often = often.select("gram", F.ceil(F.col("times") / spread).cast("int").alias("spread"))
    mine = held.select("k1", "gram").join(often, "gram").groupBy("k1")
    # A document's grams are at most its windows.
    mine = mine.agg(F.collect_list(F.struct("gram", "spread")).alias("all"))
    mine = mine.select("k1", F.col("all.gram").alias("grams"), F.col("all.spread").alias("spreads"))

    asked = rows.hint("merge").join(mine, "k1").select(*KEYS, "text", "grams", "spreads")
    cut = asked.mapInArrow(_cut(window, gram, shards), _ASKED)
    found = staging.keep(cut.groupBy("shard").applyInArrow(_shard(window), _FOUND), "found")
    staging.drop("grams")
    open_ = found.where("shard >= 0").withColumn("bucket", F.pmod("d1", F.lit(shards)))
    merged = open_.groupBy("bucket").applyInArrow(_merge, "k1 long, k2 long, start long, n int")
    gone = found.where("shard < 0").select(*KEYS, "start", "n").unionByName(merged)
    gone = gone.groupBy("k1").agg(F.collect_list(F.struct("start", "n", "k2")).alias("gone"))
    marked = rows.hint("merge").join(gone, "k1", "left").select(
        "doc_id", *KEYS, "text", F.col("gone.start").alias("at"), F.col("gone.n").alias("n"), F.col("gone.k2").alias("of")
    )
    schema = f"doc_id {kind}, k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return marked.mapInArrow(_removed(window, with_text), schema + (", kept_bytes binary" if with_text else ""))
