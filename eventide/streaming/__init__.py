"""Structured Streaming: the windowed job, sinks and progress."""

from .job import open_windows, read_summary, split_summary_stream, start, start_from_config, start_rejects, summary_stream
from .progress import ProgressLog, progress_frame, progress_rows, run_progress
from .sinks import (
    JdbcUpsertSink,
    KeyedSummaryTable,
    RejectLog,
    RevenueRollup,
    start_record_sink,
    summary_ddl,
    table_ddl,
    upsert_sql,
    write_json_lines,
)

__all__ = [
    "start",
    "read_summary",
    "ProgressLog",
    "start_from_config",
    "summary_stream",
    "progress_frame",
    "progress_rows",
    "run_progress",
    "JdbcUpsertSink",
    "KeyedSummaryTable",
    "RejectLog",
    "RevenueRollup",
    "open_windows",
    "split_summary_stream",
    "start_rejects",
    "upsert_sql",
    "start_record_sink",
    "summary_ddl",
    "table_ddl",
    "write_json_lines",
]
