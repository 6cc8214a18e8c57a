"""The keyed table's checks, top-k, rollup and compaction; the streaming job's
split watermark, state table, reject log and restart."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from eventide.config import JobConfig
from eventide.plans.registry import QUERIES
from eventide.schema import SUMMARY_SCHEMA
from eventide.session import listed, remove_folder
from eventide.sources.files import json_lines_stream
from eventide.sources.kafka import source_options
from eventide.streaming import KeyedSummaryTable, RejectLog, RevenueRollup, open_windows, read_summary, split_summary_stream, start, summary_stream
from eventide.streaming.job import start_rejects

from .conftest import SF001
from .test_streaming import FileFeed, _record

DAY = dt.datetime(2024, 1, 1)
ONCE = {"availableNow": True}


def row(day, minute, category, events, revenue=1.0):
    at = DAY + dt.timedelta(days=day, minutes=minute)
    return (at, at + dt.timedelta(minutes=1), category, events, 0, revenue)


def batch(spark, *rows):
    names = [f.name for f in SUMMARY_SCHEMA.fields]
    return spark.createDataFrame([dict(zip(names, r, strict=True)) for r in rows], "window_start timestamp, window_end timestamp, category string, event_count long, purchase_count long, total_revenue double")


def counts(df):
    return sorted((r.window_start, r.category, r.event_count) for r in df.collect())


# --- keys -------------------------------------------------------------------

def test_duplicate_and_null_keys_become_rejects(spark, workdir):
    table = KeyedSummaryTable(f"{workdir}/t", run=1)
    rows = [row(0, 0, "a", 1), row(0, 0, "a", 2), row(0, 0, "b", 3), row(0, 1, None, 4), row(0, 2, None, 5)]
    for _ in range(2):
        table(batch(spark, *rows), 0)
    assert counts(table.read(spark)) == [(DAY, "b", 3)]
    found = sorted((r.reason, r.event_count) for r in table.read_rejects(spark).collect())
    assert found == [("duplicate key", 1), ("duplicate key", 2), ("null key", 4), ("null key", 5)]


def test_a_later_batch_replaces_rows_and_rejects(spark, workdir):
    table = KeyedSummaryTable(f"{workdir}/t", run=1)
    table(batch(spark, row(0, 0, "a", 1), row(0, 0, "a", 2), row(0, 1, None, 4)), 0)
    table(batch(spark, row(0, 0, "a", 9), row(0, 1, None, 5)), 1)
    assert counts(table.read(spark)) == [(DAY, "a", 9)]
    assert sorted((r.reason, r.event_count) for r in table.read_rejects(spark).collect()) == [("duplicate key", 1), ("duplicate key", 2), ("null key", 5)]


# --- compaction -------------------------------------------------------------

def test_a_read_is_right_at_each_step_of_a_compaction(spark, workdir, monkeypatch):
    table = KeyedSummaryTable(f"{workdir}/t", run=1)
    for i in range(3):
        table(batch(spark, row(0, 0, "a", i), row(1, 0, "a", 10 + i), row(0, i, "b", i), row(0, 9, None, i), row(0, 5, "c", 1), row(0, 5, "c", i)), i)
    state = lambda: (counts(table.read(spark)), sorted((r.reason, r.category or "", r.event_count) for r in table.read_rejects(spark).collect()))
    before, seen = state(), []
    import eventide.streaming.sinks as sinks

    def watched(spark, path):
        seen.append(state())
        remove_folder(spark, path)

    monkeypatch.setattr(sinks, "remove_folder", watched)
    table.compact(spark, "2024-01-01", "2024-01-01")
    assert len(seen) == 3 and all(s == before for s in seen) and state() == before
    assert len(table.files(spark, "2024-01-01")) == 1 and len(table.files(spark, "2024-01-02")) == 3


# --- top-k ------------------------------------------------------------------

def test_latest_reads_only_the_newest_dates(spark, workdir):
    table = KeyedSummaryTable(f"{workdir}/t", run=1)
    table(batch(spark, *[row(d, m, "a", d * 10 + m) for d in range(12) for m in range(2)]), 0)
    table(batch(spark, row(11, 1, "a", 999)), 1)
    rows = table.latest(spark, 5)
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan
    read = {r.window_start.date() for r in rows.collect()}
    assert read == {dt.date(2024, 1, 12 - i) for i in range(4)}  # 1 date, then 2, then 4
    from eventide.operators import latest

    assert [r[:4] for r in map(tuple, latest(rows, 5).collect())] == [r[:4] for r in map(tuple, latest(table.read(spark), 5).collect())]
    assert counts(table.latest(spark, 100)) == counts(table.read(spark))
    assert KeyedSummaryTable(f"{workdir}/none").latest(spark, 3).collect() == []


# --- rollup -----------------------------------------------------------------

def test_rollup_rebuilds_only_touched_dates(spark, workdir):
    table = KeyedSummaryTable(f"{workdir}/t", run=1)
    rollup = RevenueRollup(f"{workdir}/r", table)
    assert rollup.refresh(spark) == [] and rollup.read(spark).collect() == []
    table(batch(spark, *[row(d, m, c, 1) for d in range(3) for m in range(3) for c in "ab"]), 0)
    assert rollup.refresh(spark) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert rollup.refresh(spark) == []
    table(batch(spark, row(1, 1, "a", 50)), 1)
    assert rollup.refresh(spark) == ["2024-01-02"]
    table.compact(spark, "2024-01-03", "2024-01-03")
    assert rollup.refresh(spark) == ["2024-01-03"]
    total = lambda df: sorted(map(tuple, df.groupBy("category").agg(F.sum("event_count"), F.sum("total_revenue")).collect()))
    assert total(rollup.read(spark)) == total(table.read(spark)) == [("a", 58, 9.0), ("b", 9, 9.0)]


def test_rollup_mends_a_lost_date(spark, workdir):
    table = KeyedSummaryTable(f"{workdir}/t", run=1)
    rollup = RevenueRollup(f"{workdir}/r", table)
    table(batch(spark, row(0, 0, "a", 1), row(1, 0, "a", 2)), 0)
    rollup.refresh(spark)
    remove_folder(spark, f"{workdir}/r/window_date=2024-01-02")
    assert rollup.refresh(spark) == ["2024-01-02"]


# --- split watermark ---------------------------------------------------------

def run_splits(spark, root, policy):
    """Split 0 is half an hour ahead of split 1; both come in four batches."""
    feeds = [FileFeed(f"{root}/{i}") for i in range(2) if not os.makedirs(f"{root}/{i}", exist_ok=True)]
    for feed, shift in zip(feeds, (1800, 0), strict=True):
        feed.push(_record(shift + 5, "a", 1))
        feed.push(_record(shift + 30, "a", 1), _record(shift + 100, "a", 1))
        feed.push(_record(shift + 110, "a", 1))
        feed.push(_record(shift + 200, "a", 1))
        for i, name in enumerate(sorted(os.listdir(feed.dir))):  # the source takes the oldest file first
            os.utime(os.path.join(feed.dir, name), (1_700_000_000 + 10 * i,) * 2)
    streams = [json_lines_stream(spark, f.dir, max_files_per_trigger=1) for f in feeds]
    start(split_summary_stream(streams), f"{root}/chk", path=f"{root}/out", trigger=ONCE, watermark_policy=policy).awaitTermination()
    return counts(read_summary(spark, f"{root}/out"))


def test_a_lagging_split_keeps_its_rows(spark, workdir):
    minute = dt.timedelta(minutes=1)
    assert run_splits(spark, f"{workdir}/min", "min") == [(DAY, "a", 2), (DAY + minute, "a", 2)]
    lost = run_splits(spark, f"{workdir}/max", "max")
    assert (DAY + minute, "a", 1) in lost  # one watermark for all takes the split's third batch for late
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"


# --- state table --------------------------------------------------------------

def test_open_windows_are_what_the_sink_lacks(spark, workdir):
    feed = FileFeed(workdir)
    feed.push(_record(5, "a", 1), _record(65, "a", 2), _record(66, None, 3), _record(69, "b", 4))
    stream = summary_stream(json_lines_stream(spark, feed.dir))
    start(stream, f"{workdir}/chk", path=f"{workdir}/out", trigger=ONCE).awaitTermination()
    assert read_summary(spark, f"{workdir}/out").count() == 0  # the watermark is at 59 s
    minute = DAY + dt.timedelta(minutes=1)
    held = sorted(((r.window_start, r.category or "", r.event_count, r.purchase_count, r.total_revenue) for r in open_windows(spark, f"{workdir}/chk").collect()))
    assert held == [(DAY, "a", 1, 1, 1.0), (minute, "", 1, 1, 3.0), (minute, "a", 1, 1, 2.0), (minute, "b", 1, 1, 4.0)]


# --- rejects on the stream ----------------------------------------------------

def test_reject_log_replays_without_duplicates(spark, workdir):
    feed = FileFeed(workdir)
    feed.push(_record(5, "a", 1), "{bad", "[]")
    feed.push("{worse")
    for again in range(2):
        records = json_lines_stream(spark, feed.dir, max_files_per_trigger=1)
        start_rejects(records, f"{workdir}/chk", f"{workdir}/bad", trigger=ONCE).awaitTermination()
        rows = RejectLog(f"{workdir}/bad").read(spark).collect()
        assert sorted((r.value, r.reason) for r in rows) == [("[]", "corrupt"), ("{bad", "corrupt"), ("{worse", "corrupt")]
        assert {r.batch_id for r in rows} == {0, 1}
        if not again:
            remove_folder(spark, f"{workdir}/chk/commits/1")
            assert listed(spark, f"{workdir}/chk/commits")


# --- flush options ------------------------------------------------------------

def test_flush_at_records_or_time():
    opts = source_options(JobConfig(), flush_records=100)
    assert (opts["minOffsetsPerTrigger"], opts["maxTriggerDelay"]) == ("100", "5s")
    assert "minOffsetsPerTrigger" not in source_options(JobConfig())
    assert source_options(JobConfig(), flush_records=7, flush_delay="2s")["maxTriggerDelay"] == "2s"


@pytest.mark.parametrize("name", ["streaming_split_watermark", "open_windows", "streaming_restart", "streaming_rejects", "upsert_duplicate_keys", "latest_from_table", "revenue_rollup"])
def test_queries_leave_no_folder(spark, name):
    from eventide.session import shared_dir

    assert QUERIES[name](spark, SF001).count() > 0
    assert listed(spark, f"{shared_dir(spark)}/eventide/{name}") == []
