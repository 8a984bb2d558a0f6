"""Substring dedup (2) and suffix arrays (4) against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from muster.llm import substring_dedup
from muster.llm.rolling import sliding_min, window_hashes
from muster.llm.substring_dedup import drop_repeats
from muster.llm.suffix_arrays import common_prefixes, suffix_array
from muster.llm.suffix_dedup import drop_repeated_bytes, fragments


def rows_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def brute_words(rows, window):
    seen, out = {}, []
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    judged = {}
    for i, t in order:
        words = t.encode().split()
        cover = [False] * len(words)
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                cover[s : s + window] = [True] * window
            else:
                seen[w] = i
        kept = b" ".join(w for w, c in zip(words, cover, strict=True) if not c)
        judged[i, t] = (i, len(words), sum(cover), hashlib.sha256(kept).hexdigest())
    for row in rows:
        out.append(judged[row])
    return sorted(out, key=str)


def brute_bytes(rows, window):
    texts = [(i, t.encode()) for i, t in rows]
    found = Counter(b[s : s + window] for _, b in texts for s in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        cover = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if found[b[s : s + window]] > 1:
                cover[s : s + window] = b"\1" * window
        kept = bytes(c for c, x in zip(b, cover, strict=True) if not x)
        spans = sum(1 for s in range(len(b)) if cover[s] and (s == 0 or not cover[s - 1]))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=str)


@pytest.mark.parametrize("window", [20, 6])
def test_repeated_words(odd, window):
    got = result(drop_repeats(odd, window), "n_words", "n_removed", "kept_sha256")
    assert got == brute_words(rows_of(odd), window)


@pytest.mark.parametrize(("window", "gram", "spread"), [(400, 32, 8192), (40, 8, 2), (24, 8, 1)])
def test_repeated_bytes(odd, window, gram, spread):
    got = result(drop_repeated_bytes(odd, window, gram, spread), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_bytes(rows_of(odd), window)


def test_texts_of_one_byte(spark):
    """Runs of one gram, cut into many fragments, across documents."""
    docs = spark.createDataFrame([(1, "a" * 9000), (2, "a" * 450), (3, "a" * 399), (4, "b" * 400), (5, "ab" * 300)], "doc_id long, text string")
    assert result(drop_repeated_bytes(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows_of(docs), 400)


def test_kept_text_and_empty(odd, none):
    assert drop_repeats(odd, with_text=True).where("doc_id = 63").first().kept_text == ""
    assert drop_repeats(none).count() == 0
    assert drop_repeated_bytes(none).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 97 + 1 + seed % 4, int(rng.integers(1, 300))).astype(np.uint8)
    data = np.concatenate([data, data[: len(data) // 2], data])
    depth, text = int(rng.integers(9, 60)), data.tobytes()
    order, place = suffix_array(data, depth)
    padded = [text[i : i + depth].ljust(depth, b"\0") for i in order]
    assert padded == sorted(padded) and sorted(order) == list(range(len(data))) and (order[place] == np.arange(len(data))).all()
    shared = common_prefixes(data, order, place, depth)
    for at in range(1, len(order)):
        a, b = text[order[at - 1] :][:depth], text[order[at] :][:depth]
        same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[at] == same


def test_fragments_hold_every_window_once():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 5, 40, 500, 0, 61_000, 39)]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    text, start, n, key, places = fragments(np.frombuffer(b"".join(texts), np.uint8), offsets, 40, 8)
    windows = Counter((t, s + i) for t, s, m in zip(text, start, n, strict=True) for i in range(m))
    assert windows == Counter((t, s) for t, b in enumerate(texts) for s in range(len(b) - 39))
    by_content = {}
    for t, s, m, k in zip(text, start, n, key, strict=True):
        for i in range(m):
            assert by_content.setdefault(texts[t][s + i : s + i + 40], k) == k  # equal windows, one gram
    assert (places >= 1).all()


def test_sliding_helpers():
    values = np.random.default_rng(1).integers(0, 1 << 60, 100).astype(np.uint64)
    assert sliding_min(values, 7).tolist() == [min(values[i : i + 7]) for i in range(94)]
    twice = np.concatenate([values, values])
    hashes = window_hashes(twice, 9, 1)
    assert (hashes[:92] == hashes[100:192]).all() and len(set(hashes.tolist())) == 100


def banner_docs(spark):
    """A phrase of 14 words amid texts that differ, a longer passage at their edges, and rows that repeat whole."""
    rng = np.random.default_rng(4)

    def own(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, n))

    banner, passage = own(14), own(30)
    rows = [(i, f"{own(12)} {banner} {own(12)}") for i in range(300)]
    rows += [(400 + i, f"{own(6)} {passage} {own(6)}") for i in range(60)]
    rows += [(500, f"{own(12)} {banner} {own(12)}")] * 200
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("most", [0, 7, 100, 1 << 40])
def test_repeats_of_a_frequent_phrase(spark, odd, most):
    for docs, window in ((banner_docs(spark), 20), (odd, 6)):
        got = result(drop_repeats(docs, window, most=most), "n_words", "n_removed", "kept_sha256")
        assert got == brute_words(rows_of(docs), window)


def test_a_frequent_phrase_is_spread(spark, monkeypatch):
    """The windows of many documents around one phrase do not meet in one group."""
    shares = {}

    def watched(asked, buckets, most, staging):
        dealt = deal(asked, buckets, most, staging)
        sizes = [r.n for r in dealt.groupBy("bucket").agg(F.sum(F.length("high") / 8).alias("n")).collect()]
        shares[most] = max(sizes) / sum(sizes)
        return dealt

    deal = substring_dedup._dealt
    monkeypatch.setattr(substring_dedup, "_dealt", watched)
    docs = banner_docs(spark)
    for most in (100, 1 << 40):
        drop_repeats(docs, most=most).count()
    # 4,200 windows in 16 groups; left together, they stay in the few groups of the phrase's blocks.
    assert shares[100] < 0.12 and shares[1 << 40] > 0.25


def test_a_passage_of_many_words_may_be_shorter_than_the_window(spark):
    """The window is bytes: a repeated passage of more than 50 words goes when it has 400 bytes, and stays under that.
    All passages of the benchmark that have more than 50 words have fewer bytes, so none goes on its own account."""
    words = [f"w{i:05}" for i in range(70)]
    short, long = " ".join(words[:55]), " ".join(words)
    assert len(short) < 400 <= len(long)
    rows = [(i, f"{i} {short} {i}") for i in range(2)] + [(10 + i, f"{i} {long} {i}") for i in range(2)]
    docs = spark.createDataFrame([(i, t.replace("w0", f"v{i // 10}")) for i, t in rows], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in drop_repeated_bytes(docs, window=400).collect()}
    assert got[0] == got[1] == 0 and got[10] == got[11] >= 400
    passages = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").where("size(split(trim(text), '[\\\\s]+')) > 50")
    assert passages.count() > 0 and passages.where("octet_length(text) >= 400").count() == 0
