"""Periodic runs of words by descending-LCP Kruskal.

A run is a maximal stretch of words with a smallest period q that is repeated at least twice (length >= 2q). In each
text

* the suffix array of its words is built by doubling, and the common prefixes of neighbours in it by Kasai's walk;
* the neighbours are united by decreasing common prefix, Kruskal's way, with union-find over ordered position sets;
* two positions i < j that become neighbours in a set at level ``l`` have exactly ``l`` words in common, and none of
  the positions between them has so many. If j - i <= l, the words from i to j + l repeat with period j - i.

Such a seed is a run when the words before i and j differ. It is the only one of that run: a smaller period would have
put a position between i and j at a higher level, and the run's first repetition is united at exactly its own level.
So runs come out whole, with their smallest period, and none is found twice. Levels under the smallest possible seed
(``(min_length + 1) // 2`` words) are never united, and a text without any repeated window of that many words has no run.

Defined cases: a NULL, empty or blank text has no words and no run. Each row is judged by itself, so rows that repeat
a doc_id are judged alike; other columns are ignored. A NULL doc_id is never spliced.

A text is the work of one task; memory is some hundred bytes a word of the longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.rolling import buffers, mix, slices, window_hashes, word_hashes, words

_SLICE = 4 << 20
_SEEDS = 131, 137


class Run(NamedTuple):
    start: int
    length: int
    period: int


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling: a suffix's class by its first 2h words is the pair of classes by h."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.zeros(n, np.int64)
    rank[order] = np.cumsum(np.r_[0, ids[order][1:] != ids[order][:-1]])
    h = 1
    while n and rank[order[-1]] < n - 1:
        follow = np.zeros(n, np.int64)  # beyond the end: before everything
        follow[: max(n - h, 0)] = rank[h:] + 1
        pair = rank * (n + 1) + follow
        order = np.argsort(pair, kind="stable")
        rank[order] = np.cumsum(np.r_[0, pair[order][1:] != pair[order][:-1]])
        h *= 2
    return order


def common_prefixes(ids: list[int], order: np.ndarray) -> list[int]:
    """Words that each suffix, in order, shares with the one before it (0 for the first), by Kasai's walk."""
    n, ordered = len(ids), order.tolist()
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    shared, common = [0] * n, 0
    for at, spot in enumerate(place.tolist()):
        if not spot:
            common = 0
            continue
        other = ordered[spot - 1]
        most = n - max(at, other)
        while common < most and ids[at + common] == ids[other + common]:
            common += 1
        shared[spot] = common
        common = common - 1 if common else 0
    return shared


def runs_of(ids: np.ndarray, min_length: int) -> list[Run]:
    """Every run of at least ``min_length`` words, by start and period."""
    least = (min_length + 1) // 2
    order = suffix_array(ids)
    text = ids.tolist()
    shared = np.array(common_prefixes(text, order), np.int64)
    edges = np.flatnonzero(shared >= least)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    owner: dict[int, int] = {}
    sets: dict[int, list[int]] = {}

    def find(at: int) -> int:
        root = at
        while owner.setdefault(root, root) != root:
            root = owner[root]
        while owner[at] != root:
            owner[at], at = root, owner[at]
        return root

    found = []

    def seed(i: int, j: int, level: int) -> None:
        period = j - i
        if period <= level and period + level >= min_length and (i == 0 or text[i - 1] != text[j - 1]):
            found.append(Run(i, period + level, period))

    for level, left, right in zip(shared[edges].tolist(), order[edges - 1].tolist(), order[edges].tolist(), strict=True):
        a, b = find(left), find(right)
        large, small = sets.setdefault(a, [a]), sets.setdefault(b, [b])
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        owner[b] = a
        mine = set(small) if len(small) > 1 else ()
        for at in small:
            insort(large, at)
        # Neighbours that were not neighbours before: one of each set. Pairs inside the smaller set that lost their
        # place between them to the other set are no neighbours any more and were judged when they met.
        for at in small:
            spot = bisect_left(large, at)
            if spot and large[spot - 1] not in mine:
                seed(large[spot - 1], at, level)
            if spot + 1 < len(large) and large[spot + 1] not in mine:
                seed(at, large[spot + 1], level)
        del sets[b]
    return sorted(found, key=lambda r: (r.start, r.period))


def dropped_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words lie in some run after its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:-1]) > 0


def spliced(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place, or None where the text stays as it is: of one id in ten, by the
    checksum of its decimal form, the tail repeats its first words."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _numbered(parts: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in parts], np.int64)


def _suspects(data: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """Which texts hold some window of ``least`` words twice."""
    starts, ends, owner = words(data, offsets)
    window = window_hashes(mix(word_hashes(data, starts, ends, _SEEDS[0])), least, _SEEDS[1])
    inside = np.flatnonzero(owner[: len(window)] == owner[least - 1 :]) if len(window) else np.zeros(0, np.int64)
    mine, window = owner[inside], window[inside]
    order = np.lexsort((window, mine))
    mine, window = mine[order], window[order]
    twice = (mine[1:] == mine[:-1]) & (window[1:] == window[:-1])
    out = np.zeros(len(offsets) - 1, bool)
    out[mine[1:][twice]] = True
    return out


def _judge(text: bytes, doc_id: int | None, suspect: bool, min_length: int, splice: bool) -> tuple[int, list[Run], bytes]:
    """Words, runs and the collapsed text."""
    parts = text.split()  # bytes: the six white-space characters of ASCII
    places = spliced(doc_id, len(parts)) if splice else None
    if places is not None:
        ids = _numbered(parts)[places]
        parts = [parts[i] for i in places.tolist()]
    elif suspect:
        ids = _numbered(parts)
    runs = runs_of(ids, min_length) if suspect or places is not None else []
    n = len(parts)
    if runs:
        parts = [w for w, gone in zip(parts, dropped_words(n, runs).tolist(), strict=True) if not gone]
    return n, runs, b" ".join(parts)


def _batches(min_length: int, splice: bool, fields: list[tuple[str, pa.DataType]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field("doc_id"), *fields])
            data, offsets = buffers(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for low, high in slices(offsets, _SLICE):
                base = offsets[low]
                part, edges = data[base : offsets[high]], offsets[low : high + 1] - base
                suspects = _suspects(part, edges, (min_length + 1) // 2).tolist()
                raw, edges = part.tobytes(), edges.tolist()
                judged = [
                    _judge(raw[edges[i] : edges[i + 1]], ids[low + i], suspects[i], min_length, splice) for i in range(high - low)
                ]
                best = [max(r, key=lambda x: (x.length, -x.start, -x.period)) if r else None for _, r, _ in judged]
                made = {
                    "doc_id": batch.column("doc_id").slice(low, high - low),
                    "n_words": [n for n, _, _ in judged],
                    "n_runs": [len(r) for _, r, _ in judged],
                    "runs": [[x._asdict() for x in r] for _, r, _ in judged],
                    "start": [b and b.start for b in best],
                    "length": [b and b.length for b in best],
                    "period": [b and b.period for b in best],
                    "exponent_milli": [b and 1000 * b.length // b.period for b in best],
                    "runs_sha256": [
                        hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in r).encode()).hexdigest() for _, r, _ in judged
                    ],
                    "collapsed": [c.decode() for _, _, c in judged] if "collapsed" in schema.names else None,
                    "collapsed_sha256": [hashlib.sha256(c).hexdigest() for _, _, c in judged],
                }
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v := made[f.name], pa.Array) else pa.array(v, f.type) for f in schema], schema=schema
                )

    return run


def periodic_runs(docs: DataFrame, min_length: int = 12, splice: bool = False, texts: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_runs, every run, the longest one (ties: first start, then smallest
    period) with its exponent in thousandths, a digest of the runs, and the text with every run cut to its first
    period (words joined by one space), whole unless ``texts`` is off, and as a digest.

    With ``splice`` one text in ten gets a periodic tail first, so that there is something to find and to measure.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    longs = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
    fields = [("n_words", pa.int64()), ("n_runs", pa.int64()), ("runs", pa.list_(pa.struct(longs))), *longs, ("exponent_milli", pa.int64())]
    fields += [("runs_sha256", pa.string()), *[("collapsed", pa.string())][: int(texts)], ("collapsed_sha256", pa.string())]
    triple = "struct<start: bigint, length: bigint, period: bigint>"
    sql = {pa.int64(): "bigint", pa.string(): "string"}
    ddl = ", ".join(f"{n} {'array<' + triple + '>' if n == 'runs' else sql[t]}" for n, t in fields)
    return rows.mapInArrow(_batches(min_length, splice, fields), f"doc_id {kind}, {ddl}")
