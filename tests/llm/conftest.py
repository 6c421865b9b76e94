"""Small tables with the awkward cases that every operator must stand."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size string, norm string, row int, score string"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "and", "of", "to"]) if rng.random() < 0.3 else "".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n))


def row(doc_id, text, source="a"):
    # The other columns have names that operators might use themselves.
    return (doc_id, text, "en", source, len(text or ""), "key", "size", "norm", 1, "score")


def awkward_rows():
    base, passage = words(1, 120), words(2, 60)
    near = base.split()
    near[60] = "changed"
    long = words(3, 30_000)
    return [
        row(1, base),
        row(2, " ".join(near)),
        row(3, base.replace(" ", "\n", 4)),
        row(4, f"{words(4, 40)} {passage} {words(5, 40)}", "b"),
        row(5, f"{words(6, 70)} {passage} {words(7, 10)}", None),
        row(6, None),
        row(7, ""),
        row(8, " \n\t "),
        row(9, "one two three"),
        row(10, "One TWO three", "b"),
        row(11, long),
        row(12, long + " end"),
        row(13, "Grüße, été ñandú — 数学   x́y 🙂 it's <|endoftext|>.", "é"),
        row(14, "a " * 300),
        row(15, "a " * 300),
        row(15, "a " * 300),
        row(None, base),
        row(None, None, None),
        row(-3, words(8, 200)),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """The smallest given documents."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
