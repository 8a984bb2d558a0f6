"""How far the sources of each language lie apart in their words, by iceberg prefix refinement.

The terms that count are those in at least ``min_docs`` documents of a language. They are found without counting every
term: byte prefixes are extended level by level. A level counts, for each language,

* the documents of every term that ends within the level's length: it is complete, and kept if they are enough;
* the documents of every longer prefix: if they are too few, no term that begins with it can be kept, and the next level
  leaves all its terms out.

The lengths double until no prefix is left that is both frequent and open. Counts are folded inside each slice of texts
before they are shuffled. The open prefixes go to the next level's tasks as a bitmap of hashes (at most ``MOST_BITS``
bits, whatever the corpus: ``common.bitmap``), whose false hits cost some counting and change nothing, as a term is kept by its own count.

Shares of kept terms, smoothed and rounded down, are compared by f = floor((p - q)^2 / q). A pair of sources is summed
over the kept terms sparsely: a term absent from both gives the same value each time, a term in one only is counted in
that source's histogram of shares, and terms in both are paired in sorted order, summed inside each task. All arithmetic
is in whole numbers.

Defined cases: a NULL text, lang or source is read as ''. Each row is a document, repeated rows included; other columns
are ignored. A group without terms has all its pairs; a language without kept terms gives 0 for each; a source that is
alone in its language has no pair. No documents, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import bitmap, in_bitmap, partitions
from muster.llm.rolling import buffers, slices
from muster.plans.staging import Staging

SCALE = 1_000_000_000
FIRST_LEVEL = 8
_SLICE = 4 << 20
_PAIRS = 1 << 20
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The terms of texts in order, lower-cased, and the text each is in."""
    letter = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(letter & (np.r_[True, ~letter[:-1]] | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    # Without the bytes between them the terms lie side by side.
    letters = np.cumsum(letter, dtype=np.int32)
    ends = np.r_[letters[starts] - 1, letters[-1:] if len(letters) else 0].astype(np.int32)
    solid = _LOWER[data[letter]]
    owner = np.searchsorted(offsets, starts, "right") - 1
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(solid)]), owner


def _hashes(lang: bytes, prefixes: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(lang + b"\0" + p) for p in prefixes], np.uint64).view(np.int64)


def _folded(left: np.ndarray, right: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and how often each occurs."""
    key, times = np.unique(left.astype(np.int64) * span + right, return_counts=True)
    return key // span, key % span, times


def _level(lang: bytes, group: np.ndarray, texts: pa.Array, alive: np.ndarray | None, before: int, length: int) -> Iterator[tuple[pa.Array, np.ndarray | None, np.ndarray, np.ndarray]]:
    """Of texts of one language: (terms, group, documents, occurrences) and (open prefixes, None, documents, hashes).
    ``alive`` names the open prefixes of the level ``before``; on the first level there is none, and all is open."""
    data, offsets = buffers(texts)
    for low, high in slices(offsets, _SLICE):
        base = offsets[low]
        terms, owner = terms_of(data[base : offsets[high]], offsets[low : high + 1] - base)
        coded = terms.dictionary_encode()
        known, ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        size = pc.binary_length(known).to_numpy(zero_copy_only=False)
        goes = size > before
        if alive is not None and goes.any():
            parents = pc.binary_slice(known.filter(pa.array(goes)), 0, before).dictionary_encode()
            open_ = in_bitmap(alive, _hashes(lang, parents.dictionary.to_pylist()))
            goes[goes] = open_[parents.indices.to_numpy(zero_copy_only=False)]
        whole, longer = goes & (size <= length), goes & (size > length)
        if whole.any():
            here = whole[ids]
            doc, term, times = _folded(owner[here], ids[here], len(known))
            key, back = np.unique(group[low + doc].astype(np.int64) * len(known) + term, return_inverse=True)
            docs = np.bincount(back, minlength=len(key))
            n = np.bincount(back, times, len(key)).astype(np.int64)
            yield known.take(pa.array(key % len(known))), key // len(known), docs, n
        if longer.any():
            prefixes = pc.binary_slice(known.filter(pa.array(longer)), 0, length).dictionary_encode()
            number = np.zeros(len(known), np.int64)
            number[longer] = prefixes.indices.to_numpy(zero_copy_only=False)
            here = longer[ids]
            _, prefix, _ = _folded(owner[here], number[ids[here]], len(prefixes.dictionary))
            docs = np.bincount(prefix, minlength=len(prefixes.dictionary))
            yield prefixes.dictionary, None, docs, _hashes(lang, prefixes.dictionary.to_pylist())


def _refolded(parts: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]], add: bool) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The slices of one batch in one: distinct (term, group) with the sums of both counts; of hashes the first."""
    if len(parts) == 1:
        return parts[0]
    coded = pa.concat_arrays([t for t, _, _, _ in parts]).dictionary_encode()
    group, docs, n = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * (group.max() + 1) + group
    key, first, back = np.unique(key, return_index=True, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, back, n)
    terms = coded.dictionary.take(pa.array(key // (group.max() + 1)))
    return terms, group[first], np.bincount(back, docs, len(key)).astype(np.int64), total if add else n[first]


def _levels(alive: np.ndarray | None, before: int, length: int):
    names = ["lang", "source", "term", "open", "docs", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang = batch.column("lang").dictionary_encode()
            codes = by_lang.indices.to_numpy(zero_copy_only=False)
            for code, lang in enumerate(by_lang.dictionary.to_pylist()):
                mine = batch.filter(pa.array(codes == code))
                sources = mine.column("source").dictionary_encode()
                group = sources.indices.to_numpy(zero_copy_only=False)
                found = list(_level(lang.encode(), group, mine.column("text"), alive, before, length))
                whole = [x for x in found if x[1] is not None]
                longer = [(t, np.zeros(len(t), np.int64), docs, hashes) for t, of, docs, hashes in found if of is None]
                for parts, complete in ((whole, True), (longer, False)):
                    if parts:
                        terms, of, docs, n = _refolded(parts, complete)
                        source = sources.dictionary.take(pa.array(of)) if complete else pa.repeat("", len(terms))
                        columns = [pa.repeat(lang, len(terms)), source, terms, pa.repeat(not complete, len(terms))]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(docs, pa.int64()), pa.array(n, pa.int64())], names=names)

    return run


def kept_terms(docs: DataFrame, staging: Staging, min_docs: int = 3, first_level: int = FIRST_LEVEL) -> DataFrame:
    """lang, source, term, n, lang_n, head: how often each kept term of a language occurs in each source that has it, and
    in all; one of a term's rows is its head."""
    rows = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    levels, alive, before, length = [], None, 0, first_level
    while alive is None or len(alive):
        found = rows.mapInArrow(_levels(alive, before, length), "lang string, source string, term binary, open boolean, docs long, n long")
        # n is a term's occurrences, or the hash of an open prefix, which is the same in every slice.
        n = F.when(F.col("open"), F.max("n")).otherwise(F.sum(F.when(~F.col("open"), F.col("n"))))
        level = staging.keep(found.groupBy("lang", "source", "term", "open").agg(F.sum("docs").alias("docs"), n.alias("n")), f"level{length}")
        levels.append(level.where("NOT open"))
        alive = bitmap(level.where(F.col("open") & (F.col("docs") >= min_docs)), "n")
        before, length = length, 2 * length
    counts = reduce(DataFrame.unionByName, levels).select("lang", "source", F.col("term").cast("string").alias("term"), "docs", "n")
    # A row for each source that has the term, at most.
    same = Window.partitionBy("lang", "term")
    sums = {"lang_docs": F.sum("docs").over(same), "lang_n": F.sum("n").over(same), "head": F.min("source").over(same) == F.col("source")}
    return counts.withColumns(sums).where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "head")


def _share(n: Column, total: Column, terms: Column, add: int) -> Column:
    """1 + floor(SCALE * (n + add) / (total + add * terms)), exact at any count."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(add)).cast("decimal(19,0)")
    return F.call_function("div", top, (total + F.lit(add) * terms).cast("decimal(19,0)")) + F.lit(1)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so the square has less than 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _group_id() -> Column:
    return F.xxhash64("lang", "source")


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over terms (t1, t2) that come together: for each two groups that have a term, what their pair's sum gains over
    the value of a term in one of them only. Sums leave a slice of pairs at a time."""
    held: np.ndarray | None = None
    for batch in batches:
        rows = np.column_stack([batch.column(c).to_numpy() for c in ("t1", "t2", "id", "p", "p0")])
        rows = rows if held is None else np.concatenate([held, rows])
        same = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
        cuts = np.flatnonzero(~same)
        done = cuts[-1] + 1 if len(cuts) else 0  # the last term may go on in the next batch
        yield from _paired(rows[:done])
        held = rows[done:]
    if held is not None:
        yield from _paired(held)


def _paired(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(rows):
        return
    fresh = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
    first = np.flatnonzero(fresh)
    size = np.diff(np.r_[first, len(rows)])
    mine = np.repeat(np.arange(len(first)), size)
    partners = size[mine]
    upto = np.cumsum(partners)
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] - partners[at] + _PAIRS, "right")))
        left = np.repeat(np.arange(at, end), partners[at:end])
        step = np.arange(len(left)) - np.repeat(upto[at:end] - partners[at:end] - (upto[at] - partners[at]), partners[at:end])
        right = first[mine[left]] + step
        other = left != right
        left, right = left[other], right[other]
        g, p, p0 = rows[left, 2], rows[left, 3], rows[left, 4]
        h, q, q0 = rows[right, 2], rows[right, 3], rows[right, 4]
        gain = (p - q) ** 2 // q - (p - q0) ** 2 // q0 - (p0 - q) ** 2 // q + (p0 - q0) ** 2 // q0
        ids, number = np.unique(np.concatenate([g, h]), return_inverse=True)
        key, back = np.unique(number[: len(g)] * len(ids) + number[len(g) :], return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, back, gain)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[key // len(ids)], ids[key % len(ids)], total)], names=["g", "h", "gain"])
        at = end


def _pair_values(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """g, h, value of every ordered pair of groups of a language: the sum of f over all kept terms."""
    left = groups.select("lang", F.col("id").alias("g"), F.col("p0").alias("g0"), "terms")
    right = groups.select("lang", F.col("id").alias("h"), F.col("p0").alias("h0"))
    pairs = left.join(right, "lang").where("g <> h")
    big = "decimal(38,0)"
    neither = divergence(F.col("g0"), F.col("h0"))
    base = pairs.select("g", "h", F.coalesce(F.col("terms").cast(big) * neither, F.lit(0)).cast(big).alias("gain"))
    # A source's terms by share: what they add against a source that lacks them, either way round.
    shares_of = shares.groupBy("id", "p").agg(F.count(F.lit(1)).cast("decimal(18,0)").alias("times"))
    alone = pairs.join(shares_of.withColumnRenamed("id", "g"), "g")
    back = divergence(F.col("h0"), F.col("g0"))
    alone = alone.groupBy("g", "h").agg(
        F.sum(F.col("times") * (divergence(F.col("p"), F.col("h0")) - neither)).cast(big).alias("one"),
        F.sum(F.col("times") * (divergence(F.col("h0"), F.col("p")) - back)).cast(big).alias("two"),
    )
    way = F.explode(F.array(F.struct("g", "h", F.col("one").alias("gain")), F.struct(F.col("h").alias("g"), F.col("g").alias("h"), F.col("two").alias("gain"))))
    alone = alone.select(way.alias("x")).select("x.*")
    spread = shares.select(F.xxhash64("lang", "term").alias("t1"), F.xxhash64("term", "lang").alias("t2"), "id", "p", "p0")
    spread = spread.repartition(partitions(shares.sparkSession), "t1", "t2").sortWithinPartitions("t1", "t2")
    both = spread.mapInArrow(_shared_terms, "g long, h long, gain long").withColumn("gain", F.col("gain").cast(big))
    return base.unionByName(alone).unionByName(both).groupBy("g", "h").agg(F.sum("gain").cast("long").alias("value"))


def divergences(docs: DataFrame, min_docs: int = 3, add: int = 1, top: int = 200, first_level: int = FIRST_LEVEL) -> DataFrame:
    """Per group (lang, source): every other source of the language with the pair's value, and the ``top`` terms that
    the group uses more than its language does; each ranked by value, then item."""
    staging = Staging(docs.sparkSession)
    counts = staging.keep(kept_terms(docs, staging, min_docs, first_level), "kept")
    every = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.when(F.col("head"), 1)).alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    groups = groups.withColumn("p0", _share(F.lit(0), F.col("total"), F.col("terms"), add)).withColumn("id", _group_id())
    groups = staging.keep(groups, "groups")
    known = counts.join(groups, ["lang", "source"])
    shares = known.select("lang", "source", "term", "id", "p0", _share(F.col("n"), F.col("total"), F.col("terms"), add).alias("p"),
                          _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), add).alias("q"))
    shares = staging.keep(shares, "shares")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    terms = more.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    names = groups.select("id", "lang", "source")
    values = _pair_values(groups, shares).join(names.withColumnRenamed("id", "g"), "g")
    values = values.join(names.select(F.col("id").alias("h"), F.col("source").alias("item")), "h").select("lang", "source", "item", "value")
    pairs = values.withColumn("rank", F.row_number().over(ranked))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
