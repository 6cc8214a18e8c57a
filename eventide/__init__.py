"""eventide — windowed event analytics on Spark.

Decode JSON events tolerantly, assign event time with a watermark, aggregate
tumbling windows per category (same definition for batch and Structured
Streaming), upsert closed windows into a keyed summary, and report on it.
"""

__version__ = "0.1.0"

from .config import JobConfig
from .functions import decode_records, encode_records, parse_event_time, rejects, valid_events
from .operators import (
    decode_quality,
    events_per_window,
    formatted,
    generate_events,
    last_period,
    latest,
    revenue_by_category,
    summary_freshness,
    totals,
    tumbling_summary,
    with_total,
)
from .session import build_session, shared_dir
from .streaming import JdbcUpsertSink, KeyedSummaryTable, progress_frame, read_summary, start, summary_stream

__all__ = [
    "JobConfig",
    "decode_records",
    "encode_records",
    "parse_event_time",
    "rejects",
    "valid_events",
    "decode_quality",
    "events_per_window",
    "formatted",
    "generate_events",
    "last_period",
    "latest",
    "revenue_by_category",
    "summary_freshness",
    "totals",
    "tumbling_summary",
    "with_total",
    "build_session",
    "shared_dir",
    "JdbcUpsertSink",
    "KeyedSummaryTable",
    "progress_frame",
    "read_summary",
    "start",
    "summary_stream",
]
