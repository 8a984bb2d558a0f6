"""Toxicity (7): folding, hits, exceptions and held-out accuracy."""

import zlib

import pytest

from muster.llm.toxicity import Lexicon, automaton, fit, fold, hits, scored, strength


@pytest.mark.parametrize(
    ("text", "word"),
    [("1D10T!", "idiot"), ("$tupid,", "stupid"), ("IDIОТ", "idiot"), ("ídîot", "idiot"), ("ｍｏｒｏｎ", "moron"), ("tr\u00adash", "trash"), ("l0s3r", "loser")],
)
def test_disguises_come_off(text, word):
    assert f" {word} " in fold(f"you {text} there")


def test_numbers_and_marks_stay_out():
    assert fold("100 2023!! a$$$ |").split() == ["a"]
    assert fold("").strip() == ""


def test_hits_and_exceptions():
    machine = automaton({" trash ": 3.0, " low": 2.0})
    found = list(hits(fold("The trash, lowly trash can below"), machine))
    assert [(a, w, b) for a, w, b, _ in found] == [("the", "trash", "lowly"), ("trash", "lowly", "trash"), ("lowly", "trash", "can")]
    alone = strength("trash can", machine, frozenset())
    assert alone > 0 == strength("trash can", machine, frozenset({("trash", "can")}))
    assert strength("trash " + "word " * 50, machine, frozenset()) < alone
    assert strength("", machine, frozenset()) == 0


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = scored(docs, fit(docs, labels)).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tests = [r for r in rows if r.held_out and r.doc_id in toxic]
    right = [r for r in tests if r.predicted == toxic[r.doc_id]]
    caught = [r for r in tests if r.predicted and toxic[r.doc_id]]
    assert len(right) > 0.97 * len(tests) and len(caught) > 0.85 * sum(toxic[r.doc_id] for r in tests)


def test_odd_rows_and_empty(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (999, 1)], "doc_id long, toxic int")
    for lexicon in (fit(odd, labels), Lexicon(), fit(none, labels), fit(odd, labels.limit(0))):
        rows = scored(odd, lexicon).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert scored(none, lexicon).count() == 0
    assert fit(none, labels) == Lexicon()
