"""Synthetic events: determinism, distribution and bounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.constants import CATEGORIES, PRICE_RANGES
from eventide.operators import generate_events


def test_independent_of_partitioning(spark):
    a = generate_events(spark, 5000, partitions=3)
    b = generate_events(spark, 5000, partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_distribution_and_bounds(spark):
    df = generate_events(spark, 100_000, partitions=4).cache()
    try:
        share = {r["event_type"]: r["count"] / 100_000 for r in df.groupBy("event_type").count().collect()}
        assert abs(share["view"] - 0.60) < 0.01 and abs(share["cart"] - 0.25) < 0.01 and abs(share["purchase"] - 0.15) < 0.01
        cats = {r["category"]: r["count"] for r in df.groupBy("category").count().collect()}
        assert set(cats) == set(CATEGORIES) and min(cats.values()) > 100_000 / 7 * 0.95
        assert df.where((F.col("event_type") != "purchase") & (F.col("amount") != 0.0)).count() == 0
        for cat, (lo, hi) in PRICE_RANGES.items():
            r = df.where((F.col("category") == cat) & (F.col("event_type") == "purchase")).agg(F.min("amount"), F.max("amount")).first()
            assert lo <= r[0] and r[1] <= hi
        assert df.where(~F.col("user_id").rlike(r"^user_0[0-4]\d\d$|^user_0500$")).count() == 0
        assert df.where(~F.col("session_id").rlike(r"^sess_0\d\d\d$")).count() == 0
        assert df.where(~F.col("product_id").rlike(r"^[a-z]+_[a-z_]+_0\d\d$")).count() == 0
        assert df.where(~F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$")).count() == 0
    finally:
        df.unpersist()


def test_rows_depend_only_on_id(spark):
    full = generate_events(spark, 1000).where("event_id = 777").first()
    from eventide.operators.generate import synthetic_events

    one = synthetic_events(spark.range(777, 778), "id").first()
    assert full == one
