import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventide.llm import mixing, sharding

from .conftest import as_set

PARTS = {"src0": 3, "src1": 2}


def test_shards_move_only_into_the_new_one(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.sharded(docs, [1.0] * 8).collect()
    grown = {r.doc_id: r.shard for r in sharding.sharded(docs, [1.0] * 9).collect()}
    assert all(r.grown_shard == grown[r.doc_id] for r in rows)
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {8}
    assert 0.07 < len(moved) / 4000 < 0.16
    weighted = Counter(r.shard for r in sharding.sharded(docs, [1.0, 1.0, 2.0]).collect())
    assert 0.44 < weighted[2] / 4000 < 0.56


def test_slots_do_not_depend_on_partitions(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = as_set(sharding.sharded(docs, [1.0] * 3))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert as_set(sharding.sharded(docs.repartition(5), [1.0] * 3)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shard_rows(odd, clashing, empty, odd_rows):
    rows = sharding.sharded(odd, [1.0] * 4).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    assert as_set(sharding.sharded(clashing, [1.0] * 4)) == as_set(sharding.sharded(odd, [1.0] * 4))
    assert sharding.sharded(empty, [1.0] * 4).collect() == []


@pytest.mark.parametrize("weights", [[1], [3, 2, 1], [24, *[4] * 20], [50, 1, 1, 1, 7], [1] * 9])
def test_schedule_deviates_less_than_one_block(spark, weights):
    rows = sorted(mixing.schedule(spark, weights).collect(), key=lambda r: r.slot)
    period, had = sum(weights), [0] * len(weights)
    assert [r.slot for r in rows] == list(range(period))
    for r in rows:
        assert list(r.before) == had and r.turn == had[r.stream]
        had[r.stream] += 1
        for h, w in zip(had, weights, strict=True):
            assert abs(h - (r.slot + 1) * w / period) < 1
    assert had == weights


def test_mixture(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "src0").when(F.col("id") % 3 == 1, "src1").otherwise("src9").alias("source")
    )
    rows = sorted(mixing.mixing_plan(docs, PARTS, 1, 4).collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(3000))
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    assert [r.slot for r in rows] == sorted(r.slot for r in rows)
    seen = Counter()
    for i, r in enumerate(rows[:1900]):  # no stream has run out yet
        seen[r.stream] += 1
        if (i + 1) % 4 == 0:
            for stream, w in enumerate((3, 2, 1)):
                assert abs(seen[stream] / 4 - (i + 1) / 4 * w / 6) < 1


def test_mixed_rows(odd, clashing, empty):
    assert as_set(mixing.mixed_rows(clashing, PARTS, 1, 2)) == as_set(clashing)
    assert mixing.mixed_rows(odd, PARTS, 1, 2).columns == odd.columns
    assert mixing.mixed_rows(empty, PARTS, 1, 2).collect() == []
    assert mixing.mixing_plan(odd, PARTS, 1, 2).count() == odd.count()
    with pytest.raises(ValueError):
        mixing.schedule(odd.sparkSession, [1, 0])
