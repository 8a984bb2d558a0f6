"""Exact dedup (9) and line dedup (1) against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from muster.llm.exact_dedup import BASES, PRIMES, _sums, drop_copies, exact_groups, strip_space
from muster.llm.line_dedup import LineRuns, drop_frequent_lines

WHITE = "[\x20\x09-\x0d]"


def brute_groups(rows):
    """(doc_id, keep_id, group_size, kept, digest), sorted; of equal rows the first is the one that may stay."""
    groups = defaultdict(list)
    for at, (i, t) in enumerate(rows):
        groups[re.sub(WHITE, "", t or "")].append((-len(t or ""), i is None, i or 0, at, i))
    out = []
    for body, members in groups.items():
        members.sort()
        for m in members:
            out.append((m[4], members[0][4], len(members), m is members[0], hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def found_groups(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_exact_groups(odd):
    assert found_groups(exact_groups(odd)) == brute_groups(texts(odd))


def test_huge_texts_combine_from_chunks(odd):
    assert found_groups(exact_groups(odd, chunk_bytes=7)) == brute_groups(texts(odd))


def test_a_normalisation_may_lengthen(odd):
    longer = exact_groups(odd, normalise=lambda text: F.concat(F.lit("0123456789"), strip_space(text)), chunk_bytes=7)
    same = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in longer.collect()}
    assert same == {row[:4] for row in brute_groups(texts(odd))}


def test_doc_id_of_another_type(odd):
    named = odd.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 3, "0")))
    for chunk_bytes in (7, 1 << 18):
        got = exact_groups(named, chunk_bytes=chunk_bytes)
        assert got.schema["doc_id"].dataType.simpleString() == "string"
        want = [(i if i is None else f"d{i:03}", k if k is None else f"d{k:03}", *rest) for i, k, *rest in brute_groups(texts(odd))]
        assert found_groups(got) == sorted(want, key=str)


def test_collisions_are_told_apart(odd):
    """Primes so small that most fingerprints of one length collide."""
    assert found_groups(exact_groups(odd, primes=(2, 2, 2, 2), bases=(1, 1, 1, 1))) == brute_groups(texts(odd))


def test_chunk_hashes_add_up():
    data = np.random.default_rng(0).integers(0, 256, 100).astype(np.uint64)
    for prime, base in zip(PRIMES, BASES, strict=True):
        whole = _sums(data, np.array([0]), np.array([100]), base, prime, 100)[0]
        parts = _sums(data, np.array([0, 40, 80]), np.array([40, 40, 20]), base, prime, 40)
        shifted = sum(int(p) * pow(base, 40 * i, prime) for i, p in enumerate(parts)) % prime
        assert int(whole) == shifted == sum(int(c) * pow(base, i, prime) for i, c in enumerate(data)) % prime


def test_copies_go_and_columns_stay(odd):
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    want = Counter((i, k) for i, k, _, stays, _ in brute_groups(texts(odd)) if stays)
    assert sum(want.values()) == kept.count()


def test_exact_empty(none):
    assert exact_groups(none).count() == 0
    assert drop_copies(none).count() == 0


def brute_lines(rows, min_docs, min_chars):
    lower = {i: i + 32 for i in range(65, 91)}

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(lower)

    docs = Counter()
    for _, t in rows:
        docs.update({k for k in map(key, (t or "").split("\n")) if len(k) >= min_chars})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if docs[key(line)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("min_docs", "min_chars", "batches", "fanout"), [(10, 1, 4, 4), (3, 1, 5, 2), (2, 9, 1, 3)])
def test_frequent_lines(odd, min_docs, min_chars, batches, fanout):
    got = drop_frequent_lines(odd, min_docs, min_chars, batches, fanout)
    rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()), key=str)
    assert rows == brute_lines(texts(odd), min_docs, min_chars)


def test_batches_that_come_later(spark, odd):
    """Runs keep counting over batches; what is settled is not counted again."""
    whole, parts = LineRuns(spark, 10), LineRuns(spark, 10, fanout=2)
    whole.add(odd)
    for at in range(3):
        parts.add(odd.where(f"coalesce(doc_id, 0) % 3 = {at}"))
    assert {tuple(r)[:2] for r in whole.settled().collect()} == {tuple(r)[:2] for r in parts.settled().collect()}


def test_lines_text_and_empty(odd, none):
    got = drop_frequent_lines(odd, 10, with_text=True).where("doc_id = 40").first()
    assert "hared" not in got.kept_text and got.n_dropped == 1
    assert drop_frequent_lines(none).count() == 0


def test_later_batches_meet_settled_runs(odd, monkeypatch):
    """With nothing but the defaults: later batches are merge-anti-joined with settled lines, without a shuffle of
    either side, and levels are merged on the way and never twice at the end."""
    plans, merged = [], []
    write, merge = LineRuns._write, LineRuns._merge

    def watched_write(self, df, *split_by):
        if self.settled_runs and "LeftAnti" in (plan := df._jdf.queryExecution().executedPlan().toString()):
            plans.append(plan)
        return write(self, df, *split_by)

    def watched_merge(self, tables, into):
        merged.append(len(tables))
        return merge(self, tables, into)

    monkeypatch.setattr(LineRuns, "_write", watched_write)
    monkeypatch.setattr(LineRuns, "_merge", watched_merge)
    got = drop_frequent_lines(odd)
    rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()), key=str)
    assert rows == brute_lines(texts(odd), 10, 1)
    assert len(plans) == 3 and merged == [4, 4]
    for plan in plans:
        assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_one_merge_is_enough(odd):
    """A run that a merge has sifted is not merged again, and asking twice changes nothing."""
    runs = LineRuns(odd.sparkSession, 10, fanout=2)
    runs.add(odd, batches=2)
    assert [len(level) for level in runs.levels] == [0, 1]
    before = runs.written
    first = {tuple(r) for r in runs.settled().collect()}
    assert runs.written == before and first and {tuple(r) for r in runs.settled().collect()} == first
    whole = LineRuns(odd.sparkSession, 10)
    whole.add(odd)
    assert {r[:2] for r in first} == {tuple(r)[:2] for r in whole.settled().collect()}


def test_no_table_is_left_in_the_catalog(spark, odd, monkeypatch):
    def left():
        return [t.name for t in spark.catalog.listTables() if t.name.startswith(runs)]

    runs = "line_runs_"
    for table in left():  # of tests that use the levels themselves
        spark.sql(f"DROP TABLE {table}")
    got = drop_frequent_lines(odd, 2, 1, batches=5, fanout=2)
    assert left() == []
    rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()), key=str)
    assert rows == brute_lines(texts(odd), 2, 1)

    def broken(self, tables, into):
        raise RuntimeError("lost")

    monkeypatch.setattr(LineRuns, "_merge", broken)
    with pytest.raises(RuntimeError, match="lost"):
        drop_frequent_lines(odd, 2, 1, batches=5, fanout=2)
    assert left() == []
