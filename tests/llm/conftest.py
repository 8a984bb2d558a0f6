import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "k1 string, size string, kept string, row string, bucket string, gone string, nth string"
)


def phrase(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_texts():
    """(doc_id, text, source): copies, near copies, shared passages and lines, blanks, NULLs, ties, a long text."""
    rng = random.Random(5)
    passage, line, base = phrase(rng, 60), "A Shared Line", phrase(rng, 120)
    rows = [(i, phrase(rng, rng.randint(1, 60)), f"s{i % 4}") for i in range(24)]
    rows += [(30 + i, f"{phrase(rng, 7 + i)} {passage} {phrase(rng, 5)}", "s0") for i in range(6)]
    rows += [(40 + i, f"{phrase(rng, 30)}\n {line.upper() if i % 2 else line}\t\n{phrase(rng, 9)}", "s1") for i in range(12)]
    rows += [(60 + i, base if i % 2 else base.replace(" ", "\n", 3) + "  ", "s2") for i in range(5)]
    near = base.split(" ")
    for i in range(5):
        near[20 * i + 3] = "edit"
        rows.append((70 + i, " ".join(near), "s2"))
    rows += [(80, None, None), (81, "", "s3"), (82, " \t\n\x0b\x0c\r", None), (83, "Ünï cödé ß 東京 " * 30, "s3"), (84, "a " * 900, "s3")]
    rows += [(85, phrase(rng, 6000) + "\n" + passage, "s3"), (86, "same row", "s0"), (86, "same row", "s0"), (86, "same row", "s0")]
    rows += [(None, phrase(rng, 25) + " " + passage, "s0"), (87, "$$$ ### *** !!! | |", "é"), (88, "WORDS IN CAPITALS ONLY!! " * 9, "é")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "xx", s, len(t or ""), "a", "b", "c", "d", "e", None, "g") for i, t, s in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
