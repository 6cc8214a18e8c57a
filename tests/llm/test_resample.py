import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventide.llm import resample
from eventide.llm.shared import Scratch

from .conftest import DOCUMENTS, as_set


def plain(docs, target, longest=1, percent=10):
    """(doc_id, n_features, weight, score, rank), by the definition."""

    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return [zlib.crc32(r.encode()) % 10_000 for r in runs], len(words)

    mine = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, f, _ in mine for b in f), Counter(b for x in target for b in features(x)[0])
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    rows = []
    for doc, found, n in mine:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in found)
        h = int(hashlib.sha256(f"2024:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, None])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = i + 1
    return sorted(((*r[:4], r[5]) for r in rows), key=repr)


TARGET = ["river stone light " * 9, None, "", "paper É 中文 cloud42 Cloud"]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (1, 60), (3, 50)])
def test_equals_the_definition(spark, odd, odd_rows, target, longest, percent):
    found = as_set(resample.resampled(odd, target, percent=percent, longest=longest))
    assert found == plain([r[:2] for r in odd_rows], TARGET, longest, percent)


def test_extra_columns_and_empty_tables(spark, odd, clashing, empty, target):
    assert as_set(resample.resampled(clashing, target)) == as_set(resample.resampled(odd, target))
    assert resample.resampled(empty, target).collect() == []
    nothing = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(i, "a few words " * (i + 1), None, None, None) for i in range(40)], DOCUMENTS)
    assert as_set(resample.resampled(docs, nothing)) == plain([(i, "a few words " * (i + 1)) for i in range(40)], [])


def test_words_over_many_pieces(monkeypatch):
    text = " ".join(f"Word{i % 37}é" for i in range(500)) + "x" * 300
    whole = resample.buckets_of(text, 2, 1000).tolist()
    monkeypatch.setattr(resample, "PIECE_BYTES", 50)
    assert resample.buckets_of(text, 2, 1000).tolist() == whole and len(whole) == 999
    assert [resample.words_in(sum(max(0, w - k) for k in range(4)), 4) for w in range(9)] == list(range(9))


def sorted_rows(spark, values, key):
    df = spark.createDataFrame(values, "a long, b long, n long").repartition(5)
    with Scratch(spark) as scratch:
        rows = resample.radix_sorted(df, key, scratch).collect()
    assert sorted(r["_at"] for r in rows) == list(range(len(values)))
    return [(r.a, r.b, r.n) for r in sorted(rows, key=lambda r: r["_at"])]


def test_radix_sort_equals_sorted(spark, monkeypatch):
    rng = random.Random(1)
    values = [(rng.choice([0, 7, 2**40 + 3]), rng.randrange(2**50) if i % 3 else 5, i) for i in range(900)]
    key = [F.col("a"), F.col("b"), F.col("n")]
    assert sorted_rows(spark, values, key) == sorted(values)
    monkeypatch.setattr(resample, "BLOCK_BITS", 3)  # many blocks; one digit holds most rows
    monkeypatch.setattr(resample, "DIGIT_BITS", 7)
    small = [(a, b % 100, n) for a, b, n in values[:300]]
    assert sorted_rows(spark, small, key) == sorted(small)


def test_radix_sort_is_stable_and_skips_shared_bits(spark):
    df = spark.createDataFrame([(7, 5, i) for i in range(50)], "a long, b long, n long")
    assert resample.digits(df, [F.col("a"), F.col("b")]) == []
    assert sorted_rows(spark, [(7, 5, 1)] * 50, [F.col("a"), F.col("b")]) == [(7, 5, 1)] * 50
    rows = df.withColumn("_at", F.col("n") * 3)  # gaps, as the first places have
    moved = resample.counting_pass(rows, (F.col("n") % 2).cast("long")).collect()
    assert [r.n for r in sorted(moved, key=lambda r: r["_at"])] == [*range(0, 50, 2), *range(1, 50, 2)]
