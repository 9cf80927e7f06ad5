from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

# Names that the operators use themselves.
CLASHING = ["row", "key", "id", "data", "size", "target", "taken", "fp", "score", "length", "part", "members", "kept_0", "order", "v", "q"]


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "anea", "thion", "ered", "onst", "hand", "wher", "reing", "tiond", "lyou", "nter"]) + rng.choice(["", "", "a", "er"]) for _ in range(n))


def awkward_rows():
    """Documents with every kind of trouble: nulls, nothing, length, ties, repeated rows."""
    rng = random.Random(5)
    shared = words(rng, 90)
    long = words(rng, 40_000)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, shared, "en", "b"), (5, shared, "en", "b"), (5, shared, "en", "b"),
        (6, "intro words only " + shared + " and an end", "en", None), (7, long, "de", "a"), (8, "x" * 70_000, "de", "c"),
        (9, long + " more", "de", "c"), (None, shared, "en", "a"), (None, None, None, None), (10, "é ñ ü ça\n" * 30, "fr", "b"),
        (11, "one", "en", "a"), (12, "two words", "en", "a"), (13, "\x1c\x00odd   space <|endoftext|> ＡＢ １２", "en", "a"),
    ]
    rows += [(100 + i, words(rng, rng.randint(1, 400)), rng.choice(["en", "fr"]), rng.choice("abcd")) for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows above with further columns whose names clash with those of the operators."""
    df = spark.createDataFrame(awkward_rows(), "doc_id long, text string, lang string, source string")
    return df.withColumns({"n_chars": F.length("text").cast("long")} | {c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(awkward):
    return awkward.limit(0)
