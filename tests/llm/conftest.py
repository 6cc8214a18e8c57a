from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that the operators use themselves.
CLASHING = ("_id", "_text", "kept", "score", "shard", "slot", "size", "stream", "block", "n_words", "component_id", "list", "reason")


def sentence(rng: random.Random, n: int) -> str:
    words = ["the", "of", "and", "river", "stone", "light", "under", "walks", "green", "never", "paper", "cloud", "seven", "quiet"]
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", "ing", "er"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    body = sentence(rng, 120)
    rows = [
        (1, body, "en", "src0", len(body)), (2, body, "en", "src0", len(body)), (1, body, "en", "src0", len(body)),
        (3, None, "en", "src0", None), (4, "", "en", "src1", 0), (5, " \n\t ", None, "src1", 4), (6, "one two", "en", None, 7),
        (None, body + " tail", "en", "src1", 1), (None, None, None, None, None), (7, sentence(rng, 40_000), "en", "src0", 9),
        (8, "x" * 70_000, "en", "src0", 9), (9, "É é 中文 😀 " * 30, "fr", "src2", 9),
    ]
    return rows + [(100 + i, sentence(rng, 80 + i), "en", f"src{i % 3}", 1) for i in range(20)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with extra columns whose names the operators use."""
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("extra").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
