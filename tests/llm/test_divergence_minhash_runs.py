"""Source divergence (11), MinHash near-dedup (12) and periodic runs (13) against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from muster.llm.common import bitmap, in_bitmap
from muster.llm.minhash import CHUNKS, WIDTH, _groups, _met, drop_near_sets, keys_of, near_sets, shingle_sets
from muster.llm.periodic_runs import Run, dropped_words, periodic_runs, runs_of
from muster.llm.source_divergence import divergences, kept_terms
from muster.plans.staging import Staging

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans({c: chr(c + 32) for c in range(0x41, 0x5B)})


# --- source divergence


def brute_divergence(rows, min_docs=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang, source) for lang, source, _ in rows}
    for lang, source, text in rows:
        found = [t.translate(UPPER) for t in TERM.findall(text)]
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        others = sorted({s for g, s in groups if g == lang})
        total = {s: sum(counts[lang, s][t] for t in kept) for s in others}
        whole = {t: sum(counts[lang, s][t] for s in others) for t in kept}

        def share(n, all_):
            return 1 + floor(Fraction(10**9 * (n + 1), all_ + len(kept)))

        def f(p, q):
            return floor(Fraction((p - q) ** 2, q))

        mine = {t: share(counts[lang, source][t], total[source]) for t in kept}
        pairs = [(s, sum(f(mine[t], share(counts[lang, s][t], total[s])) for t in kept)) for s in others if s != source]
        ours = {t: share(whole[t], sum(whole.values())) for t in kept}
        more = [(t, f(mine[t], ours[t])) for t in kept if counts[lang, source][t] and mine[t] > ours[t]]
        for part, items, most in (("pair", pairs, None), ("term", more, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, at) for at, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def divergence_rows(spark):
    rng = random.Random(3)
    words = ["Alpha", "alpha", "alphabet", "alphabetical", "Ünïted", "ÜNÏTED", "beta", "z" * 40, "z" * 41, "東京", "don't", "x1y2"]
    rows = []
    for i in range(60):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", None])
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25))), lang, source, "x"))
    rows += [(90, None, "en", "s1", "x"), (91, "", "fr", "lone", None), (92, "rare words only", "it", "s1", None), (93, None, "it", "s2", None)]
    rows += [(94, "same text", "pt", "s0", "x")] * 4 + [(95, "other", "pt", "s1", "x")]  # each row is a document
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, term string").repartition(3)


@pytest.mark.parametrize("first_level", [1, 4, 64])
def test_divergence(spark, first_level):
    docs = divergence_rows(spark)
    got = sorted(tuple(r) for r in divergences(docs, first_level=first_level).collect())
    assert got == brute_divergence([(r.lang, r.source, r.text) for r in docs.collect()])
    assert {r[0] for r in got} >= {"", "en", "it", "pt"} and not [r for r in got if r[0] == "fr"]


def test_divergence_ranks_stop(spark):
    got = divergences(divergence_rows(spark), top=2).where("part = 'term'").groupBy("lang", "source").count().collect()
    assert max(r["count"] for r in got) == 2


def test_rare_prefixes_are_not_followed(spark):
    """Under a prefix with too few documents no longer one is counted, whatever its own bytes."""
    docs = spark.createDataFrame([(i, f"abcdrare{i % 2} common longword" if i < 2 else "common longword", "en", "s") for i in range(5)], "doc_id long, text string, lang string, source string")
    staging = Staging(spark)
    kept = kept_terms(docs, staging, first_level=4)
    assert {r.term for r in kept.collect()} == {"common", "longword"}
    second = spark.read.parquet(f"{staging.folder}/level8").collect()
    assert {bytes(r.term) for r in second} == {b"common", b"longword"}


def test_bitmap_names_every_hash(spark):
    rng = np.random.default_rng(1)
    hashes = rng.integers(-(1 << 63), 1 << 63, 5000)
    words = bitmap(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h")
    assert in_bitmap(words, hashes).all()
    assert in_bitmap(words, rng.integers(-(1 << 63), 1 << 63, 5000)).mean() < 0.1
    assert not in_bitmap(bitmap(spark.createDataFrame([], "h long"), "h"), hashes).any()


# --- MinHash


def brute_near(rows, size, num, den):
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(UPPER))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    lows = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        lows[r] = doc if lows.get(r) is None else lows[r] if doc is None else min(lows[r], doc)
    out = [(doc, len(s), lows[find(i)], doc is not None and doc == lows[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]
    return sorted(out, key=str)


def found_near(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("most", [{}, {"tile": 3}, {"tile_bytes": 4000}])
def test_near_sets(odd, most):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for size, num, den in ((3, 85, 100), (5, 80, 100)):
        got = found_near(near_sets(odd, size, num, den, **most))
        assert got == brute_near(rows, size, num, den)
    assert any(r[0] != r[2] for r in got)


def chain(n):
    """Texts of which each links with the next only, and all share many keys."""
    rng = random.Random(8)
    words = ["w%d" % rng.randrange(10**6) for _ in range(400 + 9 * n)]
    return [(i, " ".join(words[9 * i : 9 * i + 400])) for i in range(n)]


def test_a_chain_comes_together(spark):
    rows = chain(40) + [(100 + i, "Few" if i else "few") for i in range(3)] + [(200, "two words"), (201, "TWO words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = found_near(near_sets(docs, 3, 85, 100, tile=5))
    assert got == brute_near(rows, 3, 85, 100)
    assert len([r for r in got if r[2] == 0]) == 40


def test_crowds_that_do_not_link(spark):
    """Many texts share keys with all others and link with none or few of them: nothing is joined that is not linked."""
    rng = random.Random(9)
    base = ["b%d" % i for i in range(300)]
    rows = []
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(300), 12):
            text[at] = f"e{i}x{at}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = found_near(near_sets(docs, 3, 85, 100, tile=16))
    assert got == brute_near(rows, 3, 85, 100)


def test_pairs_within_the_distance_meet():
    """Any pair that differs in at most 2 * CHUNKS - 1 places shares a key."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        one = rng.integers(0, 1 << 16, (1, CHUNKS * WIDTH)).astype(np.uint16)
        two = one.copy()
        at = rng.choice(CHUNKS * WIDTH, 2 * CHUNKS - 1, replace=False)
        two[0, at] ^= np.uint16(1) + rng.integers(0, 1 << 15, len(at)).astype(np.uint16) * np.uint16(2)
        assert set(keys_of(one)[0].tolist()) & set(keys_of(two)[0].tolist())


def test_nodes_that_meet_over_batches():
    rng = np.random.default_rng(4)
    keys = np.sort(rng.integers(0, 40, 60))
    rows = [(int(k), i) for i, k in enumerate(keys)]
    first = {k: i for k, i in reversed(rows)}
    want = sorted((first[k], i) for k, i in rows if (keys == k).sum() > 1)
    for cut in (1, 2, 7, 60):
        parts = [rows[i : i + cut] for i in range(0, len(rows), cut)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[c] for r in p], pa.int64()) for c in range(2)], names=["key", "node"]) for p in parts]
        got = [x for b in _met(iter(batches)) for x in zip(b.column("one").to_pylist(), b.column("node").to_pylist(), strict=True)]
        assert sorted(got) == want


def test_groups_over_batches():
    rng = np.random.default_rng(5)
    by = np.sort(rng.integers(0, 12, 50))
    rows = [(int(x) // 3, int(x) % 3, i) for i, x in enumerate(by)]
    for cut in (1, 3, 50):
        parts = [rows[i : i + cut] for i in range(0, len(rows), cut)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[c] for r in p], pa.int64()) for c in range(3)], names=["one", "tile", "node"]) for p in parts]
        got = [b.column("node").to_pylist() for b in _groups(iter(batches))]
        assert got == [np.flatnonzero(by == x).tolist() for x in np.unique(by)]


def test_shingle_sets_of_short_texts():
    texts = [b"", b"a", b"A", b"a b", b"b a", b"a b c", b" \n", b"a b c a b c a b c"]
    offsets = np.cumsum([0, *map(len, texts)])
    sets, starts = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets, 3)
    found = [tuple(sets[s:e].tolist()) for s, e in zip(starts[:-1], starts[1:], strict=True)]
    assert [len(f) for f in found] == [0, 1, 1, 1, 1, 1, 0, 3]
    assert found[1] == found[2] and len(set(found)) == 6 and found[5][0] in found[7]


@pytest.mark.parametrize("broadcast", ["-1", "262144"])
def test_sets_are_dealt_twice(spark, odd, broadcast, monkeypatch):
    """Shuffles of sets do not depend on what Spark may broadcast: one by key, one by group."""
    plans, keep = [], Staging.keep

    def noted(self, df, name):
        plans.append(df)
        return keep(self, df, name)

    monkeypatch.setattr(Staging, "keep", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        near_sets(odd, 3, 85, 100)
        text = "\n".join(df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")) for df in plans)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    inputs = re.findall(r"^\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*)\]", text, re.M)
    sets = [x for x in inputs if re.search(r"\bset#", x) or "valueSet#" in x and "s1#" not in x]
    assert len(sets) == 2, inputs


def test_drop_near_sets_keeps_columns_and_blanks(odd):
    kept = drop_near_sets(odd, 3, 85, 100)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    groups = near_sets(odd, 3, 85, 100)
    assert set(ids) >= {r.doc_id for r in groups.where("n_shingles = 0 OR kept").collect()}
    assert {80, 81, 82} <= set(ids)


# --- periodic runs


def brute_runs(ids, least):
    """Stretches that agree with themselves some words on; one inside a run of a smaller period has that period too."""
    x, out = np.asarray(ids), []
    for q in range(1, len(x) // 2 + 1):
        same = np.r_[False, x[q:] == x[:-q], False].astype(int)
        edge = np.diff(same)
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            length = e - s + q
            inside = any(r.start <= s and s + length <= r.start + r.length and q % r.period == 0 for r in out)
            if length >= max(least, 2 * q) and not inside:
                out.append(Run(s, length, q))
    return sorted(out, key=lambda r: (r.start, r.period))


def brute_periodic(doc_id, text, splice):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if splice and doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = brute_runs([numbers[w] for w in words], 12)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r.length, r.start, r.period)) if runs else None
    told = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    longest = (*best, 1000 * best.length // best.period) if best else (None,) * 4
    return (doc_id, len(runs), *longest, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("splice", [True, False])
def test_periodic_runs(spark, odd, splice):
    extra = [(1000 + i, " ".join("abc"[: 1 + i % 3] * (5 + i)) + " end " + "x y z w " * i) for i in range(40)]
    extra += [(2000, "a b a b a b a b a b a b a b a b a c a b a b a b a b a b a b a b a b a b"), (None, "r " * 40)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = sorted((tuple(r) for r in periodic_runs(docs, splice=splice).select(*COLUMNS).collect()), key=str)
    assert got == sorted((brute_periodic(r.doc_id, r.text, splice) for r in docs.collect()), key=str)


def test_collapsed_text_and_runs_are_returned(spark):
    docs = spark.createDataFrame([("t", "one two three " + "go on " * 8 + "stop"), ("u", None)], "doc_id string, text string")
    rows = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert rows["t"].collapsed == "one two three go on stop" and [tuple(r) for r in rows["t"].runs] == [(3, 16, 2)]
    assert rows["u"].n_words == 0 and rows["u"].collapsed == "" and rows["u"].runs == [] and rows["u"].start is None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([2, 5, 12]))
def test_runs_of(ids, least):
    got = runs_of(np.array(ids, np.int64), least)
    assert got == brute_runs(ids, least)
    gone = {i for s, n, p in got for i in range(s + p, s + n)}
    assert np.flatnonzero(dropped_words(len(ids), got)).tolist() == sorted(gone)


def test_long_runs_are_found_fast():
    assert runs_of(np.zeros(200_000, np.int64), 12) == [Run(0, 200_000, 1)]
    assert runs_of(np.arange(100_000) % 1000, 12) == [Run(0, 100_000, 1000)]


def test_no_documents(none):
    assert divergences(none).collect() == [] and near_sets(none).collect() == [] and periodic_runs(none).collect() == []
