"""Tumbling event-time window x category aggregate — the job's one query.

Same function for batch and Structured Streaming. Physical plan: projection of
the window struct (tumbling windows need no Expand), partial HashAggregate in
each scan task, Exchange on (window, category), final HashAggregate. The
partial step turns any number of raw rows of a hot key into one row per key
per task, so a category holding a third of all events costs one partial row
per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_WINDOW_MINUTES, PURCHASE

SUMMARY_COLUMNS = ("window_start", "window_end", "category", "event_count", "purchase_count", "total_revenue")


def window_duration(minutes: int) -> str:
    if minutes <= 0:
        raise ValueError("window must be at least one minute")
    return f"{minutes} minutes"


def tumbling_summary(events: DataFrame, minutes: int = DEFAULT_WINDOW_MINUTES, time_col: str = "event_time") -> DataFrame:
    """Epoch-aligned half-open [start, end) windows; rows with NULL time are in
    no window. Counts every event type; revenue sums every row's amount (the
    generator writes 0.0 for non-purchases) and is 0.0 when all are NULL; a
    NULL category is its own group."""
    return (
        events.groupBy(F.expr(f"window(`{time_col}`, '{window_duration(minutes)}') AS window"), F.col("category"))
        .agg(
            F.expr("count(1) AS event_count"),
            F.expr(f"count(CASE WHEN event_type = '{PURCHASE}' THEN 1 END) AS purchase_count"),
            F.expr("coalesce(sum(amount), 0.0D) AS total_revenue"),
        )
        .selectExpr(
            "window.start AS window_start",
            "window.end AS window_end",
            "category",
            "event_count",
            "purchase_count",
            "total_revenue",
        )
    )
