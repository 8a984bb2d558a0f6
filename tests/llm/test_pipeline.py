"""The five stages in a row, each held against brute force over the rows the stage before it left."""

import random
import re
from collections import Counter

import pytest
from test_exact_and_lines import brute_groups
from test_mix_pack_simhash import brute_prints, brute_targets, check_packing
from test_rules_and_urls import WORD, measure

import corpus_pipeline
from muster.plans.staging import Staging

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def phrase(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def documents():
    """Copies, copies but for white space, near copies, equal rows, NULLs, rejected and kept rows of several sources."""
    rng = random.Random(11)
    base, long = phrase(rng, 300), phrase(rng, 2500)
    rows = [(i, phrase(rng, rng.randint(20, 90)), f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, base, f"s{i % 2}") for i in range(5)]
    rows += [(110 + i, base.replace(" ", "\n", 2 + i) + " ", "s2") for i in range(4)]
    words = base.split(" ")
    for i in range(4):
        words[30 * i + 7] = "edit"
        rows.append((120 + i, " ".join(words), None))
    rows += [(130, long, "s1"), (131, long, "s1"), (132, phrase(rng, 40), None), (None, phrase(rng, 40), "s0"), (None, base, "s0")]
    same = phrase(rng, 30)
    rows += [(140, same, "s0"), (140, same, "s0"), (140, same, "s0"), (141, same, "s2")]
    # One rule each: too short, blank, missing, repeated words, symbols, repeated lines, capitals, marks, long words.
    good, line = phrase(rng, 40), phrase(rng, 4)
    bad = ["too short", " \n\t", None, "a b c d e f g h " * 30, good + " # # # # #", good + f"\n{line}" * 5, good + " LOUD" * 20, good + " so!" * 20, ("z" * 30 + " ") * 2 + " ".join(good[i] * (21 + i) for i in range(30))]
    rows += [(150 + at, t, ("s0", None)[at % 2]) for at, t in enumerate(bad)]
    return [(i, t, "xx", s, len(t or "")) for i, t, s in rows]


def is_kept(text):
    n_words, chars, symbols, same_lines, covered = measure(text)
    text = text or ""
    n_lines = sum(1 for line in text.split("\n") if re.search(WORD, line))
    failed = [
        n_words < 20, 100 * covered > 30 * n_words, 10 * symbols > n_words, same_lines > 2 and 10 * same_lines > 3 * n_lines,
        10 * len(re.findall("[A-Z]{2,}", text)) > 3 * n_words, 10 * len(re.findall("!+", text)) > 3 * n_words,
        chars > 20 * n_words or chars < 2 * n_words,
    ]
    return not any(failed)


def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


def bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(documents(), schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def done(spark, folder):
    """The rows of each table that run() writes, read when the next one is there, and what run() returns."""
    tables, keep = [], Staging.keep

    def watched(self, df, name):
        out = keep(self, df, name)
        if name[:2] in ("0-", "1-", "2-", "3-", "4-"):
            tables.append((name, out.columns, out.collect()))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Staging, "keep", watched)
        last = corpus_pipeline.run(spark, folder)
    return tables, last.collect()


@pytest.fixture(scope="module")
def stages(done):
    return [rows for _, _, rows in done[0]]


def test_run_writes_every_stage_in_turn(done):
    tables, last = done
    assert [n for n, _, _ in tables] == [
        "0-quality-rules", "1-exact-dedup", "2-SimHash-near-dedup", "3-mixing-sources", "4-packing"
    ]
    assert all(columns == COLUMNS for _, columns, _ in tables[:4])
    assert bag(last) == bag(tables[-1][2]) and last


def test_rejected_rows_go(stages):
    assert bag(stages[0]) == Counter(row for row in documents() if is_kept(row[1]))
    assert len(stages[0]) >= 50 and not set(range(150, 159)) & {r.doc_id for r in stages[0]}


def test_one_of_equal_texts_stays(stages):
    before, after = stages[:2]
    want = Counter(k for _, k, _, stays, _ in brute_groups(pairs(before)) if stays)
    assert Counter(r.doc_id for r in after) == want
    assert not bag(after) - bag(before) and len(after) < len(before)


def test_one_of_near_copies_stays(stages):
    before, after = stages[1:3]
    groups = {c for _, _, c in brute_prints(pairs(before))}
    assert sorted((r.doc_id for r in after), key=str) == sorted(groups, key=str)
    assert not bag(after) - bag(before) and len(after) < len(before)


def test_rows_are_repeated_to_the_targets(stages):
    before, after = stages[2:4]
    copies, sizes = bag(after), {tuple(r): measure(r.text)[0] for r in before}
    assert set(copies) <= set(bag(before)) and max(bag(before).values()) == 1
    by_source = Counter()
    for row, size in sizes.items():
        by_source[row[3]] += size
    want = brute_targets(by_source)
    for source, target in want.items():
        mine = [row for row in sizes if row[3] == source]
        rate = target / by_source[source]
        assert all(int(rate) <= copies[row] <= -(-rate // 1) for row in mine)
        assert abs(sum(sizes[row] * copies[row] for row in mine) - target) <= max(sizes[row] for row in mine)
    assert max(copies.values()) == 2


def test_repeated_rows_are_packed_whole(stages):
    mixed, packed = stages[3:]
    assert check_packing(packed, pairs(mixed)) < 0.5
    assert any(r.start >= 2048 for r in packed) and max(Counter((r.doc_id, r.start) for r in packed).values()) == 2
