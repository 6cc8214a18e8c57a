"""Tumbling aggregate semantics and plan shape."""

from __future__ import annotations

from eventide.plans.inspect import physical_plan, uses_python

import datetime as dt

from eventide.operators import tumbling_summary

T0 = dt.datetime(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame(rows, "category string, event_type string, amount double, event_time timestamp")


def test_counts_revenue_and_edges(spark):
    rows = [
        ("a", "purchase", 10.0, T0 + dt.timedelta(seconds=5)),
        ("a", "view", 0.0, T0 + dt.timedelta(seconds=59, microseconds=999999)),
        ("a", "cart", None, T0 + dt.timedelta(seconds=60)),  # next window (half-open)
        ("b", "purchase", None, T0 + dt.timedelta(seconds=1)),  # all-NULL amounts -> 0.0
        (None, "view", 1.5, T0 + dt.timedelta(seconds=2)),  # NULL category is a group
        ("a", "purchase", 99.0, None),  # no event time: in no window
        ("a", "signup", 2.0, T0 + dt.timedelta(seconds=3)),  # any event type counts
    ]
    out = {
        (r["window_start"], r["category"]): r
        for r in tumbling_summary(_events(spark, rows)).collect()
    }
    a0 = out[(T0, "a")]
    assert (a0["event_count"], a0["purchase_count"], a0["total_revenue"]) == (3, 1, 12.0)
    assert a0["window_end"] == T0 + dt.timedelta(minutes=1)
    a1 = out[(T0 + dt.timedelta(minutes=1), "a")]
    assert (a1["event_count"], a1["purchase_count"], a1["total_revenue"]) == (1, 0, 0.0)
    assert out[(T0, "b")]["total_revenue"] == 0.0 and out[(T0, "b")]["purchase_count"] == 1
    assert out[(T0, None)]["event_count"] == 1
    assert len(out) == 4


def test_epoch_aligned_7_minutes(spark):
    t = dt.datetime(2024, 1, 1, 0, 3)
    out = tumbling_summary(_events(spark, [("a", "view", 0.0, t)]), 7).first()
    start_min = int(out["window_start"].replace(tzinfo=dt.timezone.utc).timestamp()) // 60
    assert start_min % 7 == 0
    assert out["window_start"] <= t < out["window_end"]


def test_partial_then_final_aggregate(spark):
    df = tumbling_summary(_events(spark, [("a", "view", 0.0, T0)]))
    plan = physical_plan(df)
    assert "partial_count" in plan and "Exchange hashpartitioning" in plan
    assert not uses_python(df)
