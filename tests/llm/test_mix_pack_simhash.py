"""Mixing (8), packing (5) and SimHash near-dedup (10)."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from muster.llm.components import components
from muster.llm.mixing import draws, mix, targets
from muster.llm.packing import best_pattern, first_fit, pack, plan
from muster.llm.simhash import drop_near_copies, fingerprint, hex_print, near_groups, spanning_links
from muster.llm.tokens import Encoder
from muster.plans.staging import Staging

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """The excess of full sources is shared again by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / whole > limit * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / whole for s in open_}
        for s in full:
            out[s] = limit * sizes[s]
        left, open_ = left - sum(out[s] for s in full), open_ - full
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, "d": 0, None: 50}, {"b": 7}, {"a": 0, None: 0}, {"a": 1, "é": 2, "z": 100, "B": 3}])
def test_targets_are_one_level_of_water(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(frame).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_draws(odd):
    first, second = draws(odd).collect(), draws(odd.repartition(7)).collect()
    assert Counter((r.k1, r.nth, r.copies) for r in first) == Counter((r.k1, r.nth, r.copies) for r in second)
    words = [(r.source, len(re.findall("[^\x20\x09-\x0d]+", r.text or ""))) for r in odd.select("source", "text").collect()]
    assert Counter((r.source, r.size) for r in first) == Counter(words)
    want = brute_targets({s: sum(n for x, n in words if x == s) for s in {x for x, _ in words}})
    for source, target in want.items():
        mine = [r for r in first if r.source == source]
        longest = max(r.size for r in mine)
        assert abs(mine[0].target - target) < 1e-6
        assert abs(sum(r.size * r.copies for r in mine) - target) <= longest
        assert all(0 <= r.copies <= 2 for r in mine)


def test_expectation_and_sum(spark):
    """Over seeds a document's mean number of copies comes to its rate; the sum of a source always does."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(120)], "doc_id long, text string, source string")
    total = defaultdict(float)
    for seed in range(1, 7):
        taken = defaultdict(float)
        for r in draws(docs, seed=seed, group=5, reserve=10).collect():
            total[r.doc_id % 2] += r.copies * r.size / 6
            taken[r.source] += r.copies * r.size
            rate = r.target / r.source_size
            assert r.copies in (int(rate), int(rate) + 1)
        want = brute_targets({s: sum(1 + i % 9 for i in range(120) if "ab"[i % 2] == s) for s in "ab"})
        assert all(abs(taken[s] - want[s]) <= 9 for s in want)


def best_miss(sizes, rate, target):
    """The least miss of the target that any choice of whole copies reaches."""
    whole = int(rate + 1e-12)
    sums = {0}
    for n in sizes:
        sums |= {x + n for x in sums}
    return min(abs(whole * sum(sizes) + x - target) for x in sums)


def test_small_sources_come_as_near_as_their_documents_allow(spark):
    rng = np.random.default_rng(3)
    rows, sizes = [], defaultdict(list)
    for at in range(12):
        for _ in range(1 + at):
            n = int(rng.integers(1, 30)) if rng.random() < 0.8 else int(rng.integers(200, 500))
            rows.append((len(rows), "w " * n, f"s{at:02}"))
            sizes[f"s{at:02}"].append(n)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in (1, 2):
        drawn = draws(docs, seed=seed).collect()
        for source, all_ in sizes.items():
            mine = [r for r in drawn if r.source == source]
            miss = abs(sum(r.size * r.copies for r in mine) - mine[0].target)
            assert miss <= best_miss(all_, mine[0].target / sum(all_), mine[0].target) + 1e-6, source


@pytest.mark.parametrize("options", [{}, {"group": 8, "reserve": 40}])
def test_one_long_document_does_not_miss_the_target(spark, options):
    """A document longer than all that is left to give, among many short ones; through one fold, and through the tree."""
    rows = [(i, "w " * (5 + i * 7 % 40), "a") for i in range(300)] + [(900, "w " * 9000, "a"), (901, "w " * 2500, "a")]
    rows += [(1000 + i, "w " * 50, "b") for i in range(900)] + [(3000, "w " * 20000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn = draws(docs, **options).collect()
    for source in "ab":
        mine = [r for r in drawn if r.source == source]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= 25, source
    assert Counter((r.k1, r.copies) for r in drawn) == Counter((r.k1, r.copies) for r in draws(docs.repartition(5), **options).collect())


@pytest.mark.parametrize("sf, share", [("sf0.001", 0.01), ("sf0.01", 0.01)])
def test_sources_of_the_test_data_meet_their_targets(spark, sf, share):
    taken, target = Counter(), {}
    for r in draws(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).collect():
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= share * t for s, t in target.items())


def test_documents_keep_their_expectation(spark):
    """Long and short documents are taken as often as their source's rate, over many sources alike."""
    rows = [(i, "w " * (60 if i % 20 == 0 else 3 + i % 5), f"s{i // 200:02}") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    extra = {True: [], False: []}
    for r in draws(docs).collect():
        rate = r.target / r.source_size
        if 0.05 < rate % 1 < 0.95:
            extra[r.size == 60].append(r.copies - rate)
    for found in extra.values():
        assert len(found) > 100 and abs(np.mean(found)) < 4 * 0.5 / np.sqrt(len(found))


def test_mix_repeats_rows(odd, none):
    drawn = Counter()
    for r in draws(odd).collect():
        drawn[r.doc_id, r.source] += r.copies
    mixed = mix(odd)
    assert mixed.columns == odd.columns
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +drawn
    assert draws(none).count() == 0 and mix(none).count() == 0


def test_no_python_in_the_mix(odd):
    text = draws(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_encoder_agrees_with_the_library(odd):
    encode, library = Encoder(PATH), Tokenizer.from_file(PATH)
    assert encode.shortcut
    odd_ones = ["it's DON'T we're I'll", "<|endoftext|> x", "Ünïcödé ß 123 a1b2 ...", "", "Ça va? 5² µm ×", "Σίσυφος", "á İ \x0b x\x0cy", "ﬁ ª º", "\u00a0 \u2003x"]
    for text in odd_ones + [r.text or "" for r in odd.select("text").collect()]:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def check_packing(rows, docs):
    """Each id of each row in one piece, sequences gapless and not too long; the share of padding."""
    library = Tokenizer.from_file(PATH)
    pieces, sequences, want = Counter(), defaultdict(list), Counter()
    for r in rows:
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert pieces == want
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return 1 - sum(r.length for r in rows) / (2048 * max(1, len(sequences)))


def test_pack(odd, none):
    check_packing(pack(odd, PATH).collect(), [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    with_ids = pack(odd, PATH, with_ids=True).first()
    assert zlib.crc32(np.array(with_ids.ids, "<u4").tobytes()) == with_ids.ids_crc32
    assert pack(none, PATH).count() == 0


def test_padding_is_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert check_packing(pack(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]) < 0.01


def test_plan_holds_the_histogram():
    rng = np.random.default_rng(2)
    for n in (1, 7, 60, 2000):
        sizes = np.minimum(rng.geometric(0.02, n), 128)
        histogram = {int(s): int(c) for s, c in zip(*np.unique(sizes, return_counts=True), strict=True)}
        chosen = plan(histogram, 128)
        held = sum(p * t for p, t in chosen)
        assert {s: int(held[s]) for s in np.flatnonzero(held)} == histogram
        assert all((p * np.arange(129)).sum() <= 128 for p, _ in chosen)
        bound = -(-int(sizes.sum()) // 128)
        simple = sum(t for _, t in first_fit(np.array(sorted(histogram)), np.array([histogram[s] for s in sorted(histogram)]), 128))
        assert bound <= sum(t for _, t in chosen) <= simple + 2


def test_knapsack():
    value, pattern = best_pattern(np.array([3, 5, 7]), np.array([3.0, 6.0, 8.0]), 11)
    assert value == 12.0 and pattern.tolist() == [0, 2, 0]


def brute_prints(rows, shingle=4, bits=4):
    prints = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[s : s + shingle]) for s in range(max(1, len(words) - shingle + 1))] if words else []
        ones = [sum(xxhash.xxh64_intdigest(p, 42) >> b & 1 for p in parts) for b in range(64)]
        prints.append((i, sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))))
    group = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= bits and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    low = {}
    for (i, _), g in zip(prints, group, strict=True):
        low[g] = min((x for x in (low.get(g), i) if x is not None), default=None)
    return sorted(((i, format(p, "016x"), low[g]) for (i, p), g in zip(prints, group, strict=True)), key=str)


@pytest.mark.parametrize("tile", [20_000, 2])
def test_near_groups(odd, tile):
    got = near_groups(odd, tile=tile).select("doc_id", hex_print().alias("p"), "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_prints([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])


def test_near_groups_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = near_groups(docs).select("doc_id", hex_print().alias("p"), "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_prints([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_one_of_each_group_stays(odd, none):
    kept = drop_near_copies(odd)
    groups = {c for _, _, c in brute_prints([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])}
    assert kept.columns == odd.columns and sorted(kept.select("doc_id").collect(), key=str) == sorted(((g,) for g in groups), key=str)
    assert near_groups(none).count() == 0 and drop_near_copies(none).count() == 0


def test_fingerprint_over_segments(monkeypatch):
    text = ("One two  three\n" * 500 + "x" * 300).encode()
    whole = fingerprint(text, 4)
    monkeypatch.setattr("muster.llm.simhash._SEGMENT", 100)
    assert fingerprint(text, 4) == whole
    assert fingerprint(b" \n", 4) == 0 and fingerprint(b"A b", 4) == xxhash.xxh64_intdigest(b"a b", 42)


def test_spanning_links_span():
    rng = np.random.default_rng(0)
    centers = rng.integers(0, 1 << 64, 20, np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64) for _ in range(40)]
    prints = np.unique(np.concatenate([centers, *(centers ^ a ^ b for a, b in zip(flips[::2], flips[1::2], strict=True))]))
    left, right = spanning_links(prints, 4, 24)
    assert (np.bitwise_count(left ^ right) <= 4).all() and len(left) == len(prints) - 20


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (7, 7), (200, 205), (205, 203), (203, 200)]
    found = components(spark.createDataFrame(edges, "a long, b long"), Staging(spark))
    assert {r.node: r.root for r in found.collect()} == {**{i: 0 for i in range(1, 31)}, 101: 100, 205: 200, 203: 200}
