"""The streaming job: records -> decode -> event time + watermark -> tumbling
aggregate -> sink. Append mode emits a window once, when the watermark
(max event time seen - delay) passes its end; rows older than the watermark
are dropped and counted in ``numRowsDroppedByWatermark``."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import JobConfig
from ..constants import DEFAULT_WINDOW_MINUTES, WATERMARK_DELAY
from ..functions.decode import decode_records, rejects, valid_events
from ..operators.quality import quality_counters
from ..operators.tumble import tumbling_summary
from ..schema import SUMMARY_SCHEMA
from ..session import setting
from .sinks import RejectLog

WATERMARK_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def summary_stream(
    records: DataFrame,
    minutes: int = DEFAULT_WINDOW_MINUTES,
    delay: str = WATERMARK_DELAY,
    strict: bool = True,
    observe_quality: bool = False,
) -> DataFrame:
    """Closed-window summary rows of a record stream (or of a batch)."""
    decoded = decode_records(records)
    if observe_quality:
        # The decode-quality counters of each micro-batch, in
        # progress.observedMetrics: no extra job, no extra pass.
        decoded = decoded.observe("decode_quality", *quality_counters(strict))
    events = valid_events(decoded, strict=strict)
    return tumbling_summary(events.withWatermark("event_time", delay), minutes)


def split_summary_stream(
    splits: Sequence[DataFrame], minutes: int = DEFAULT_WINDOW_MINUTES, delay: str = WATERMARK_DELAY, strict: bool = True
) -> DataFrame:
    """``summary_stream`` with a watermark per source split (a topic partition, a
    folder): each split has its own, and the least of them counts, so that the
    rows of a split that lags behind still join their windows. A split
    without rows holds all windows open. Start it with ``start``."""
    events = [valid_events(decode_records(s), strict=strict).withWatermark("event_time", delay) for s in splits]
    return tumbling_summary(functools.reduce(DataFrame.unionByName, events), minutes)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a stopped job of this checkpoint still holds, with their
    counts so far: its keyed state read as a table (Spark's state data source).
    The session needs the state store provider that the job ran with."""
    state = spark.read.format("statestore").option("operatorId", 0).load(checkpoint)
    # Aggregate buffers in the order of tumbling_summary; their own names repeat.
    held = F.col("value").cast("struct<events: bigint, purchases: bigint, revenue: double>")
    return state.select("key", held.alias("held")).select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"), F.col("key.category").alias("category"),
        F.col("held.events").alias("event_count"), F.col("held.purchases").alias("purchase_count"),
        F.coalesce("held.revenue", F.lit(0.0)).alias("total_revenue"),
    )


def start_rejects(
    records: DataFrame, checkpoint: str, path: str, trigger: dict | None = None, query_name: str | None = None
) -> StreamingQuery:
    """Keep the records that the decoder skips: a query of its own beside the
    summary's, with its own checkpoint, into a ``RejectLog`` at ``path``."""
    writer = rejects(decode_records(records)).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.foreachBatch(RejectLog(path)).start()


def start(
    summary: DataFrame,
    checkpoint: str,
    sink: str | object = "parquet",
    path: str | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    watermark_policy: str = "min",
) -> StreamingQuery:
    """Start the query. ``sink`` is "parquet" (append files at ``path``,
    partitioned by ``window_date``; read them with ``read_summary``) or a
    ``foreachBatch`` function such as ``KeyedSummaryTable``/``JdbcUpsertSink``.
    ``trigger`` defaults to a 5 s processing-time trigger (the flush interval);
    pass ``{"availableNow": True}`` for a bounded catch-up run. State goes to
    the session's state store provider; ``build_session`` chooses RocksDB, any
    other session keeps its own choice and its results are the same."""
    # Of several watermarks the least counts; a query keeps what it starts with.
    with setting(summary.sparkSession, WATERMARK_POLICY, watermark_policy):
        return _started(summary, checkpoint, sink, path, trigger, query_name)


def _started(summary: DataFrame, checkpoint: str, sink, path: str | None, trigger: dict | None, query_name: str | None) -> StreamingQuery:
    if sink == "parquet":
        summary = summary.withColumn("window_date", F.to_date("window_start"))
    writer = summary.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    if query_name:
        writer = writer.queryName(query_name)
    if sink == "parquet":
        if not path:
            raise ValueError("parquet sink needs a path")
        return writer.format("parquet").partitionBy("window_date").option("path", path).start()
    return writer.foreachBatch(sink).start()


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """What the parquet sink has written at ``path`` (all columns nullable, as
    files are; with ``window_date`` to prune by)."""
    fields = [T.StructField(f.name, f.dataType, True) for f in SUMMARY_SCHEMA.fields]
    return spark.read.schema(T.StructType([*fields, T.StructField("window_date", T.DateType(), True)])).parquet(path)


def start_from_config(
    records: DataFrame,
    cfg: JobConfig,
    checkpoint: str,
    sink,
    path: str | None = None,
    available_now: bool = False,
    observe_quality: bool = False,
) -> StreamingQuery:
    """The configured job. ``available_now`` processes what is available (in
    as many micro-batches as the source limits allow) and stops: a bounded
    backfill on the same checkpoint as the continuous job."""
    summary = summary_stream(records, cfg.window_minutes, cfg.watermark_delay, cfg.strict_time, observe_quality)
    trigger = {"availableNow": True} if available_now else {"processingTime": cfg.trigger_interval}
    return start(summary, checkpoint, sink, path, trigger)
