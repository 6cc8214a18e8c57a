"""Structured Streaming: watermark, append emission, late rows, restart and
the keyed upsert sink (FIXTURES.md §7-§8)."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from eventide.sources.files import json_lines_stream
from eventide.streaming import KeyedSummaryTable, progress_frame, read_summary, run_progress, start, summary_stream
from eventide.streaming.progress import PROGRESS_SCHEMA

T0 = dt.datetime(2024, 1, 1)


def _record(sec: float, cat: str | None, amount: float) -> str:
    t = T0 + dt.timedelta(seconds=sec)
    d = {"event_type": "purchase", "amount": amount, "timestamp": t.strftime("%Y-%m-%dT%H:%M:%S.%f") + "+00:00"}
    if cat is not None:
        d["category"] = cat
    return json.dumps(d)


class FileFeed:
    """Drops one JSON-lines file per micro-batch into a watched folder."""

    def __init__(self, root: str):
        self.dir = os.path.join(root, "in")
        os.makedirs(self.dir)
        self.n = 0

    def push(self, *records: str) -> None:
        tmp = os.path.join(self.dir, f".tmp{self.n}")
        with open(tmp, "w") as f:
            f.write("\n".join(records) + "\n")
        os.rename(tmp, os.path.join(self.dir, f"batch{self.n:04d}.json"))
        self.n += 1


def _rows(spark, path):
    df = read_summary(spark, path)
    return sorted((r["window_start"], r["category"], r["event_count"], r["total_revenue"]) for r in df.collect())


def test_watermark_append_and_late_rows(spark, workdir):
    feed = FileFeed(workdir)
    feed.push(_record(5, "a", 1), _record(50, "a", 2))
    q = start(
        summary_stream(json_lines_stream(spark, feed.dir, max_files_per_trigger=1)),
        f"{workdir}/chk",
        sink="parquet",
        path=f"{workdir}/out",
        trigger={"processingTime": "0 seconds"},
    )
    try:
        q.processAllAvailable()
        feed.push(_record(65, "a", 1))
        q.processAllAvailable()
        feed.push(_record(30, "a", 99))  # out of order, window still open: kept
        q.processAllAvailable()
        assert not os.path.exists(f"{workdir}/out") or _rows(spark, f"{workdir}/out") == []
        feed.push(_record(70, "b", 1))  # watermark reaches 00:01:00 -> [00:00, 00:01) closes
        q.processAllAvailable()
        q.processAllAvailable()
        assert _rows(spark, f"{workdir}/out") == [(T0, "a", 3, 102.0)]
        # late row (dropped and counted) with a row that has no event time
        # (in no window, and not counted as dropped)
        no_time = json.dumps({"category": "a", "event_type": "view", "amount": 0.0})
        feed.push(_record(31, "a", 7), no_time, _record(80, "b", 1))
        q.processAllAvailable()
        q.processAllAvailable()
        assert _rows(spark, f"{workdir}/out") == [(T0, "a", 3, 102.0)]
        prog = progress_frame(spark, q)
        assert prog.agg({"dropped_by_watermark": "sum"}).first()[0] == 1
    finally:
        q.stop()


def test_restart_completes_half_filled_window_and_upserts(spark, workdir):
    feed = FileFeed(workdir)
    table = KeyedSummaryTable(f"{workdir}/table")

    def run():
        q = start(
            summary_stream(json_lines_stream(spark, feed.dir, max_files_per_trigger=1)),
            f"{workdir}/chk",
            sink=table,
            trigger={"availableNow": True},
        )
        q.awaitTermination()

    feed.push(_record(5, "a", 1), _record(50, "a", 2), _record(51, None, 2))
    feed.push(_record(65, "a", 4))
    run()
    assert table.read(spark).count() == 0  # watermark 00:00:55: nothing closed yet
    feed.push(_record(110, "a", 5))
    feed.push(_record(150, "b", 1))
    run()  # restart on the same checkpoint
    got = sorted((r["window_start"], r["category"], r["event_count"], r["total_revenue"]) for r in table.read(spark).collect())
    assert got == [(T0, "a", 2, 3.0), (T0 + dt.timedelta(minutes=1), "a", 2, 9.0)]
    rej = table.read_rejects(spark).collect()
    assert [(r["category"], r["event_count"]) for r in rej] == [(None, 1)]


SUMMARY = "window_start timestamp, window_end timestamp, category string, event_count long, purchase_count long, total_revenue double"
M = dt.timedelta(minutes=1)


def _batch(spark, *rows):
    return spark.createDataFrame([(T0 + m * M, T0 + (m + 1) * M, c, n, 0, 0.0) for m, c, n in rows], SUMMARY)


def _table(table, spark):
    return {((r["window_start"] - T0) // M, r["category"]): r["event_count"] for r in table.read(spark).collect()}


def test_replayed_batch_is_idempotent_and_changes_replace(spark, workdir):
    table = KeyedSummaryTable(f"{workdir}/t")
    assert _table(table, spark) == {}
    for _ in range(2):  # replay of the same batch id
        table(_batch(spark, (0, "a", 2), (0, "b", 1), (0, None, 5)), 7)
    assert _table(table, spark) == {(0, "a"): 2, (0, "b"): 1}
    assert [r["event_count"] for r in table.read_rejects(spark).collect()] == [5]
    table(_batch(spark, (0, "a", 102)), 8)
    assert _table(table, spark) == {(0, "a"): 102, (0, "b"): 1}


def test_a_new_run_wins_at_lower_and_equal_batch_ids(spark, workdir):
    for compacted in (False, True):
        path = f"{workdir}/t{compacted}"
        first = KeyedSummaryTable(path)
        for b in range(4):
            first(_batch(spark, (b, "a", b), (0, "z", 100 + b), (b, None, 1)), b)
        if compacted:
            first.compact(spark, "2024-01-01", "2024-01-01")
        second = KeyedSummaryTable(path)
        assert second.run > first.run
        second(_batch(spark, (1, "a", 11), (9, "new", 1), (1, None, 7)), 0)
        second(_batch(spark, (0, "z", 7), (8, "new", 2)), 3)
        expected = {(0, "a"): 0, (1, "a"): 11, (2, "a"): 2, (3, "a"): 3, (0, "z"): 7, (9, "new"): 1, (8, "new"): 2}
        assert _table(second, spark) == expected
        assert sorted(r["event_count"] for r in second.read_rejects(spark).collect()) == [1, 1, 1, 7]
        if compacted:
            second.compact(spark, "2024-01-01", "2024-01-01")
            assert _table(second, spark) == expected
            assert second.versions(spark).count() == len(expected) + 4


def test_compaction_rewrites_only_the_dates_given(spark, workdir):
    table = KeyedSummaryTable(f"{workdir}/c")
    days = 24 * 60
    for b in range(3):
        table(_batch(spark, (0, "a", b), (days, "a", 10 + b), (2 * days, "a", 20 + b)), b)
    before = set(os.listdir(f"{workdir}/c/window_date=2024-01-03"))
    table.compact(spark, "2024-01-01", "2024-01-02")
    assert set(os.listdir(f"{workdir}/c/window_date=2024-01-03")) == before
    assert table.versions(spark).count() == 1 + 1 + 3
    assert _table(table, spark) == {(0, "a"): 2, (days, "a"): 12, (2 * days, "a"): 22}


def test_run_progress_sums_batches_once(spark):
    rows = [
        (0, "2024-01-01T00:00:01.000Z", 10, 1.0, 1.0, "1970-01-01T00:00:00.000Z", 4, 0),
        (1, "2024-01-01T00:00:02.000Z", 5, 1.0, 1.0, "2024-01-01T00:00:00.500Z", 3, 2),
        (1, "2024-01-01T00:00:03.000Z", 0, 0.0, 0.0, "2024-01-01T00:00:00.500Z", 3, 0),  # an idle trigger reports again
    ]
    got = run_progress(spark.createDataFrame(rows, PROGRESS_SCHEMA)).select("*", F.unix_millis("watermark").alias("ms")).collect()
    assert [(r.input_rows, r.dropped_by_watermark, r.state_rows, r.ms) for r in got] == [(15, 2, 3, 1704067200500)]
    none = run_progress(spark.createDataFrame([], PROGRESS_SCHEMA)).collect()
    assert [tuple(r) for r in none] == [(0, 0, 0, None)]


def test_progress_log_misses_nothing(spark, workdir):
    from eventide.streaming import ProgressLog

    feed = FileFeed(workdir)
    for i in range(5):
        feed.push(_record(60 * i, "a", 1))
    log = ProgressLog(spark, f"{workdir}/progress", every=2)
    spark.streams.addListener(log)
    try:
        q = start(summary_stream(json_lines_stream(spark, feed.dir, max_files_per_trigger=1)), f"{workdir}/chk", path=f"{workdir}/out", trigger={"availableNow": True})
        q.awaitTermination()
        for _ in range(100):  # listeners are told a little later
            if os.path.exists(f"{workdir}/progress") and not log.held and spark.read.parquet(f"{workdir}/progress").count() >= 5:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    log.flush()
    rows = spark.read.parquet(f"{workdir}/progress")
    assert rows.where("num_input_rows = 1").count() == 5


def test_observed_decode_counters(spark, workdir):
    feed = FileFeed(workdir)
    feed.push(_record(5, "a", 1), "{broken", "", _record(6, "b", 2))
    q = start(
        summary_stream(json_lines_stream(spark, feed.dir), observe_quality=True),
        f"{workdir}/chk",
        sink="parquet",
        path=f"{workdir}/out",
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    metrics = [p["observedMetrics"].get("decode_quality") for p in q.recentProgress if p["numInputRows"]]
    assert metrics and metrics[0]["total_records"] == 4 and metrics[0]["accepted_records"] == 2
    assert metrics[0]["corrupt_records"] == 1 and metrics[0]["empty_records"] == 1


def test_generate_cli_writes_decodable_json_lines(spark, workdir):
    from eventide.cli import _generate
    from eventide.functions.decode import decode_records, valid_events

    class A:
        events, out, partitions = 500, f"{workdir}/gen", 3

    _generate(A, spark)
    v = valid_events(decode_records(spark.read.text(f"{workdir}/gen"), keep=()))
    assert v.count() == 500 and v.where("event_time IS NULL").count() == 0


def test_committed_files_are_archived(spark, workdir):
    feed = FileFeed(workdir)
    feed.push(_record(5, "a", 1))
    archive = os.path.join(workdir, "archive")
    q = start(
        summary_stream(json_lines_stream(spark, feed.dir, clean_source="archive", archive_dir=archive)),
        f"{workdir}/chk",
        sink="parquet",
        path=f"{workdir}/out",
        trigger={"processingTime": "0 seconds"},
    )
    try:
        q.processAllAvailable()
        feed.push(_record(100, "a", 1))
        q.processAllAvailable()
        q.processAllAvailable()
    finally:
        q.stop()
    archived = [f for _, _, files in os.walk(archive) for f in files if f.endswith(".json")]
    assert "batch0000.json" in archived


def test_cli_stream_backfill_into_keyed_table(spark, workdir):
    from eventide.cli import _generate, main

    class G:
        events, out, partitions, kafka = 2000, f"{workdir}/in", 2, False

    _generate(G, spark)
    args = ["stream", "--source", "files", "--input", f"{workdir}/in", "--sink", "table",
            "--path", f"{workdir}/table", "--checkpoint", f"{workdir}/chk", "--available-now"]
    main(args)
    t = KeyedSummaryTable(f"{workdir}/table").read(spark)
    # 2000 events at 10/s span 200 s: windows [0,1), [1,2), [2,3) minutes close
    assert t.select("window_start").distinct().count() == 3
    assert t.groupBy().sum("event_count").first()[0] == 1800
    main(args)  # rerun on the same checkpoint: nothing new, nothing duplicated
    assert KeyedSummaryTable(f"{workdir}/table").read(spark).groupBy().sum("event_count").first()[0] == 1800
