"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the whole ``events`` table (or data Spark derives from it).

Output conventions shared with the SQL oracle: timestamps as TIMESTAMP_NTZ
(UTC wall clock), money as DECIMAL(18,2), summary revenue rounded to cents.

Each query makes its plan in UTC (``in_utc``) and gives the caller's zone
back: window edges are epoch-aligned instants and the summary's timestamps are
UTC, so results must not depend on the caller's zone. Streaming queries write
below ``shared_dir`` and remove their folder when they are done.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decode import decode_records, rejects, valid_events
from ..functions.encode import encode_records
from ..operators import (
    decode_quality,
    events_per_window,
    formatted,
    last_period,
    latest,
    revenue_by_category,
    summary_freshness,
    totals,
    tumbling_summary,
    with_total,
)
from ..session import in_utc, kept, listed, move_into, remove_folder, setting, shared_dir
from ..sources.files import events_record_stream, events_stream, parquet_stream
from ..sources.kafka import sample_records
from ..sources.testdata import TOPIC_PARTITIONS, events_as_records, events_to_typed, events_to_wire, read_table
from ..streaming.job import open_windows, read_summary, split_summary_stream, start, start_rejects, summary_stream
from ..streaming.progress import progress_frame, run_progress
from ..streaming.sinks import KeyedSummaryTable, RejectLog, RevenueRollup
from .fixtures import dirty_records, null_amounts

# Fixed report parameters of the registered queries (as_of replaces NOW()).
REPORT_AS_OF = "2024-01-30 12:00:00"
EMPTY_AS_OF = "2024-03-01 00:00:00"  # after the last event: empty period
FRESHNESS_AS_OF = "2024-01-31 00:00:00"
TITLE_24H = "  CLICKSTREAM ANALYTICS REPORT — Last 24 Hours"
LATE_FILES = 4
LAG_MINUTES = 30
OLD_DATE = "2024-01-05"
PROGRESS_UPDATES = 100_000
MICROS = "unix_micros(CAST(ts AS TIMESTAMP))"


def ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as TIMESTAMP_NTZ (UTC wall clock) for comparison."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def rounded(summary: DataFrame) -> DataFrame:
    return summary.withColumn("total_revenue", F.round("total_revenue", 2))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_wire(_events(spark, sf_dir))


def _summary(spark: SparkSession, sf_dir: str, minutes: int = 1) -> DataFrame:
    """Summary through the full wire path: JSON records -> decode -> window."""
    records = events_as_records(_events(spark, sf_dir))
    return tumbling_summary(valid_events(decode_records(records)), minutes)


def _report_summary(spark: SparkSession, sf_dir: str, since: dt.datetime | None = None, until: dt.datetime | None = None) -> DataFrame:
    """Summary for the reports, from typed columns (reports read a summary
    table in production; they never re-decode raw records). The bounds reach
    the scan; windows are whole minutes, so the lower one goes back to a
    minute's start and no window that counts is cut."""
    events = _events(spark, sf_dir)
    if since is not None:
        events = events.where(F.col("ts") >= F.lit(since.replace(second=0, microsecond=0).isoformat(" ")).cast("timestamp_ntz"))
    if until is not None:
        events = events.where(F.col("ts") < F.lit(until.isoformat(" ")).cast("timestamp_ntz"))
    return tumbling_summary(events_to_typed(events), 1)


def _dirty_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_records(dirty_records(_wire(spark, sf_dir)))


def _run_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/eventide/{name}/{uuid.uuid4().hex}"


def _taken(spark: SparkSession, result: DataFrame, run: str) -> DataFrame:
    """``result`` stored by Spark, so that the run's folder can go at once."""
    result = kept(result)
    remove_folder(spark, run)
    return result


# --- aggregates --------------------------------------------------------------

def tumble(minutes: int) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ntz(rounded(_summary(spark, sf_dir, minutes)))

    q.__name__ = f"tumble_{minutes}m"
    return q


def tumble_null_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode_records(null_amounts(_wire(spark, sf_dir)))
    return ntz(rounded(tumbling_summary(valid_events(decode_records(records)))))


# --- decode ------------------------------------------------------------------

def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = events_as_records(_events(spark, sf_dir))
    return ntz(valid_events(decode_records(records), keep=("partition", "offset")))


def parse_events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(valid_events(_dirty_decoded(spark, sf_dir), keep=("partition", "offset")))


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(_dirty_decoded(spark, sf_dir))


def parse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_quality(_dirty_decoded(spark, sf_dir))


# --- reports -----------------------------------------------------------------

def report_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(latest(_report_summary(spark, sf_dir)))


def report_revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by_category(_report_summary(spark, sf_dir))


def report_events_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(events_per_window(_report_summary(spark, sf_dir)))


def _period(spark: SparkSession, sf_dir: str, hours: int, as_of: str = REPORT_AS_OF, limit: int | None = 100) -> DataFrame:
    until = dt.datetime.fromisoformat(as_of)
    summary = _report_summary(spark, sf_dir, until - dt.timedelta(hours=hours), until)
    return last_period(summary, as_of=as_of, period=f"{hours} hours", limit=limit)


def report_last_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(_period(spark, sf_dir, 1))


def report_last_period_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(_period(spark, sf_dir, 24))


def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(_period(spark, sf_dir, 24))


def report_totals_whole_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over every row of the period (``limit=None``), not only the
    rows a printed report shows."""
    return totals(_period(spark, sf_dir, 24, limit=None))


def report_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(with_total(_period(spark, sf_dir, 24)))


def report_totals_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(_period(spark, sf_dir, 1, as_of=EMPTY_AS_OF))


def report_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(_period(spark, sf_dir, 24), TITLE_24H)


def report_formatted_whole_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the period printed, with totals of exactly these rows."""
    return formatted(_period(spark, sf_dir, 24, limit=None), TITLE_24H)


def report_formatted_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(_period(spark, sf_dir, 1, as_of=EMPTY_AS_OF))


def summary_freshness_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(summary_freshness(_report_summary(spark, sf_dir), as_of=FRESHNESS_AS_OF))


# --- streaming ---------------------------------------------------------------

def _run_stream(summary: DataFrame, checkpoint: str, sink="parquet", path: str | None = None) -> None:
    start(summary, checkpoint, sink=sink, path=path, trigger={"availableNow": True}).awaitTermination()


def streaming_tumble_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File stream, watermark 10 s, append to parquet; closed windows only."""
    run = _run_dir(spark, "streaming_tumble_1m")
    _run_stream(summary_stream(events_record_stream(spark, sf_dir)), f"{run}/checkpoint", path=f"{run}/summary")
    return _taken(spark, ntz(rounded(read_summary(spark, f"{run}/summary").drop("window_date"))), run)


def streaming_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a run has come, from its own updates: rows read, rows dropped as late,
    windows still open, watermark. The run remembers the updates of all its
    batches (up to ``PROGRESS_UPDATES``), small records that don't grow with a batch."""
    run = _run_dir(spark, "streaming_progress")
    with setting(spark, "spark.sql.streaming.numRecentProgressUpdates", str(PROGRESS_UPDATES)):
        query = start(summary_stream(events_record_stream(spark, sf_dir)), f"{run}/checkpoint", path=f"{run}/summary", trigger={"availableNow": True})
    query.awaitTermination()
    return _taken(spark, ntz(run_progress(progress_frame(spark, query))), run)


def streaming_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several micro-batches, the last one late: nine tenths of the events in
    three slices of time, then the withheld tenth of all times at once. Each
    slice is ``LATE_FILES`` files and a trigger takes as many, so the watermark
    moves between slices. A batch drops the rows of windows that had ended by
    the watermark of the batch before it: the withheld rows of the first two
    slices' windows go, the others still join theirs."""
    run = _run_dir(spark, "streaming_late_rows")
    events = _events(spark, sf_dir)
    at = F.expr("unix_micros(CAST(ts AS TIMESTAMP))")
    lo, hi = (x or 0 for x in events.agg(F.min(at), F.max(at)).first())
    late = F.col("event_id") % 10 == 3
    for i in range(4):
        bounds = (at >= lo + (hi - lo) * i // 3) & ((at < lo + (hi - lo) * (i + 1) // 3) if i < 2 else F.lit(True))
        part = events.where(late) if i == 3 else events.where(~late & bounds)
        part.repartition(LATE_FILES).write.mode("append").parquet(f"{run}/events")
    stream = parquet_stream(spark, f"{run}/events", events.schema, max_files_per_trigger=LATE_FILES)
    _run_stream(summary_stream(events_as_records(stream)), f"{run}/checkpoint", path=f"{run}/summary")
    return _taken(spark, ntz(rounded(read_summary(spark, f"{run}/summary").drop("window_date"))), run)


def upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream into the keyed table, then replay the whole stream from a fresh
    checkpoint into the same table: every key is written again, nothing is
    duplicated, before and after compaction."""
    run = _run_dir(spark, "upsert_replay")
    for attempt in range(2):
        table = KeyedSummaryTable(f"{run}/table")
        _run_stream(summary_stream(events_record_stream(spark, sf_dir)), f"{run}/attempt{attempt}", sink=table)
        if attempt == 0:
            table.compact(spark, "2024-01-01", "2024-01-15")
    return _taken(spark, ntz(rounded(table.read(spark).drop("window_date"))), run)


def upsert_resubmit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resubmitted job with a fresh checkpoint: batch ids begin at 0 again,
    some keys come with other values, some are new, and the rest must stay.

    The first run streams the events whose id is not divisible by 3 and leaves
    out the category books; the second streams the events with an even id, in
    all categories. The first run's older half is compacted in between."""
    run = _run_dir(spark, "upsert_resubmit")
    streams = (
        events_to_wire(events_stream(spark, sf_dir)).where("event_id % 3 <> 0 AND category <> 'books'"),
        events_to_wire(events_stream(spark, sf_dir)).where("event_id % 2 = 0"),
    )
    for i, wire in enumerate(streams):
        table = KeyedSummaryTable(f"{run}/table")
        _run_stream(summary_stream(encode_records(wire)), f"{run}/checkpoint{i}", sink=table)
        if i == 0:
            table.compact(spark, "2024-01-01", "2024-01-15")
    return _taken(spark, ntz(rounded(table.read(spark).drop("window_date"))), run)


def summary_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows whose key is NULL (category missing) land in rejects."""
    run = _run_dir(spark, "summary_rejects")
    table = KeyedSummaryTable(f"{run}/table")
    records = dirty_records(events_to_wire(events_stream(spark, sf_dir)))
    _run_stream(summary_stream(records), f"{run}/checkpoint", sink=table)
    return _taken(spark, ntz(rounded(table.read_rejects(spark).drop("reason"))), run)


def _slices(spark: SparkSession, sf_dir: str, n: int) -> list[tuple[int, int]]:
    """The events' whole time in ``n`` equal parts: (from, before), in microseconds."""
    lo, hi = (x or 0 for x in _events(spark, sf_dir).agg(F.min(F.expr(MICROS)), F.max(F.expr(MICROS))).first())
    return [(lo + (hi - lo) * i // n, lo + (hi - lo) * (i + 1) // n + (i == n - 1)) for i in range(n)]


def streaming_split_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A watermark per topic partition: each partition is a folder of its own, four
    micro-batches bring a quarter of the time each, and the last partition's
    rows come ``LAG_MINUTES`` late. Under the least watermark none of them is
    too late; windows close when all partitions have passed them."""
    run = _run_dir(spark, "streaming_split_watermark")
    events, partition = _events(spark, sf_dir), F.col("event_id") % TOPIC_PARTITIONS
    lag = LAG_MINUTES * 60_000_000
    for lo, hi in _slices(spark, sf_dir, 4):
        for p in range(TOPIC_PARTITIONS):
            late = lag if p == TOPIC_PARTITIONS - 1 else 0
            rows = events.where((partition == p) & (F.expr(MICROS) >= lo - late) & (F.expr(MICROS) < hi - late))
            rows.repartition(LATE_FILES).write.mode("append").parquet(f"{run}/events/partition={p}")
    splits = [
        events_as_records(parquet_stream(spark, f"{run}/events/partition={p}", events.schema, max_files_per_trigger=LATE_FILES)) for p in range(TOPIC_PARTITIONS)
    ]
    _run_stream(split_summary_stream(splits), f"{run}/checkpoint", path=f"{run}/summary")
    return _taken(spark, ntz(rounded(read_summary(spark, f"{run}/summary").drop("window_date"))), run)


def open_windows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a finished run still holds in its state: the windows not closed yet."""
    run = _run_dir(spark, "open_windows")
    _run_stream(summary_stream(events_record_stream(spark, sf_dir)), f"{run}/checkpoint", path=f"{run}/summary")
    return _taken(spark, ntz(rounded(open_windows(spark, f"{run}/checkpoint"))), run)


def streaming_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one checkpoint: the older half of the events, then a part file
    that no run has committed lands in the output, then the rest. The sink's
    own log says what counts, and each closed window is there once."""
    run = _run_dir(spark, "streaming_restart")
    events = _events(spark, sf_dir)
    for i, (lo, hi) in enumerate(_slices(spark, sf_dir, 2)):
        events.where((F.expr(MICROS) >= lo) & (F.expr(MICROS) < hi)).repartition(LATE_FILES).write.mode("append").parquet(f"{run}/events")
        stream = events_as_records(parquet_stream(spark, f"{run}/events", events.schema))
        _run_stream(summary_stream(stream), f"{run}/checkpoint", path=f"{run}/summary")
        if i == 0:
            stray = read_summary(spark, f"{run}/summary").withColumn("event_count", F.col("event_count") + 1)
            stray.write.partitionBy("window_date").parquet(f"{run}/stray")
            move_into(spark, f"{run}/stray", f"{run}/summary")
    return _taken(spark, ntz(rounded(read_summary(spark, f"{run}/summary").drop("window_date"))), run)


def streaming_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that the decoder skips, from a stream. Its last batch runs three
    times: its commit is taken back twice, as if the driver had been lost
    between the sink's write and the commit."""
    run = _run_dir(spark, "streaming_rejects")
    events = _events(spark, sf_dir)
    for lo, hi in _slices(spark, sf_dir, 2):
        events.where((F.expr(MICROS) >= lo) & (F.expr(MICROS) < hi)).repartition(LATE_FILES).write.mode("append").parquet(f"{run}/events")
    for _ in range(3):
        stream = parquet_stream(spark, f"{run}/events", events.schema, max_files_per_trigger=LATE_FILES)
        records = dirty_records(events_to_wire(stream))
        start_rejects(records, f"{run}/checkpoint", f"{run}/rejects", trigger={"availableNow": True}).awaitTermination()
        commits = [n for n in listed(spark, f"{run}/checkpoint/commits") if n.isdigit()]
        remove_folder(spark, f"{run}/checkpoint/commits/{max(commits, key=int)}")
    found = RejectLog(f"{run}/rejects").read(spark).select("partition", "offset", "value", "reason")
    return _taken(spark, found, run)


def upsert_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that breaks the table's key: the windows of books come twice with
    different counts. Both rows are rejects with a reason, all others stay."""
    run = _run_dir(spark, "upsert_duplicate_keys")
    table = KeyedSummaryTable(f"{run}/table")

    def doubled(batch: DataFrame, batch_id: int) -> None:
        again = batch.where("category = 'books'").withColumn("event_count", F.col("event_count") + 1)
        for _ in range(2):  # a replay appends the same rows
            table(batch.unionByName(again), batch_id)

    _run_stream(summary_stream(events_record_stream(spark, sf_dir)), f"{run}/checkpoint", sink=doubled)
    rows = table.read(spark).drop("window_date").withColumn("reason", F.lit(None).cast("string"))
    return _taken(spark, ntz(rounded(rows.unionByName(table.read_rejects(spark)))), run)


# --- reports over the stored table ---------------------------------------------

def latest_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``report_latest`` over the stored table: only the newest dates are read."""
    run = _run_dir(spark, "latest_from_table")
    table = KeyedSummaryTable(f"{run}/table")
    table(_report_summary(spark, sf_dir), 0)
    return _taken(spark, ntz(latest(table.latest(spark, 10))), run)


def revenue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``revenue_by_category`` from sums by date, after keys of an old date were
    replaced: the first batch has wrong counts for a day, the second mends them."""
    run = _run_dir(spark, "revenue_rollup")
    table = KeyedSummaryTable(f"{run}/table")
    rollup = RevenueRollup(f"{run}/rollup", table)
    summary = kept(_report_summary(spark, sf_dir))
    old = F.to_date("window_start") == F.lit(OLD_DATE).cast("date")
    table(summary.withColumn("event_count", F.when(old, 7 * F.col("event_count")).otherwise(F.col("event_count"))), 0)
    rollup.refresh(spark)
    table(summary.where(old), 1)
    table.compact(spark, OLD_DATE, OLD_DATE)
    rollup.refresh(spark)
    return _taken(spark, revenue_by_category(rollup.read(spark)), run)


# --- sources and sinks ---------------------------------------------------------

def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five records: picked as typed rows, then encoded."""
    return encode_records(sample_records(_wire(spark, sf_dir), 5))


def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' own fields, written as JSON records and decoded again."""
    decoded = decode_records(encode_records(_wire(spark, sf_dir), keep=("event_id",)), keep=("event_id",))
    return ntz(valid_events(decoded, keep=("event_id",)))


_MADE: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tumble_1m": tumble(1),
    "tumble_7m": tumble(7),
    "tumble_1h": tumble(60),
    "tumble_null_amounts": tumble_null_amounts,
    "parse_events": parse_events,
    "parse_events_dirty": parse_events_dirty,
    "parse_rejects": parse_rejects,
    "parse_quality": parse_quality,
    "report_latest": report_latest,
    "revenue_by_category": report_revenue_by_category,
    "events_per_window": report_events_per_window,
    "report_last_period": report_last_period,
    "report_last_period_24h": report_last_period_24h,
    "report_totals": report_totals,
    "report_totals_whole_period": report_totals_whole_period,
    "report_with_total": report_with_total,
    "report_totals_empty": report_totals_empty,
    "report_formatted": report_formatted,
    "report_formatted_whole_period": report_formatted_whole_period,
    "report_formatted_empty": report_formatted_empty,
    "summary_freshness": summary_freshness_query,
    "streaming_tumble_1m": streaming_tumble_1m,
    "streaming_progress": streaming_progress,
    "streaming_late_rows": streaming_late_rows,
    "upsert_replay": upsert_replay,
    "upsert_resubmit": upsert_resubmit,
    "summary_rejects": summary_rejects,
    "streaming_split_watermark": streaming_split_watermark,
    "open_windows": open_windows_query,
    "streaming_restart": streaming_restart,
    "streaming_rejects": streaming_rejects,
    "upsert_duplicate_keys": upsert_duplicate_keys,
    "latest_from_table": latest_from_table,
    "revenue_rollup": revenue_rollup,
    "sample_events": sample_events,
    "encode_roundtrip": encode_roundtrip,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: in_utc(make) for name, make in _MADE.items()}
