"""Progress of streaming queries as a DataFrame (batch id, input rows, rates,
watermark, state rows, rows dropped as late).

``progress_frame`` shows what a query still remembers: its last
``spark.sql.streaming.numRecentProgressUpdates`` updates. ``ProgressLog`` is a
listener and misses none: it appends every update to a Parquet folder.
``run_progress`` sums either up, a row a run."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("num_input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("dropped_by_watermark", T.LongType()),
    ]
)


def _as_dict(p) -> dict:
    if isinstance(p, dict):
        return p
    return json.loads(p.json)


def progress_row(progress) -> tuple:
    d = _as_dict(progress)
    ops = d.get("stateOperators") or []
    return (
        d.get("batchId"),
        d.get("timestamp"),
        d.get("numInputRows"),
        float(d.get("inputRowsPerSecond") or 0.0),
        float(d.get("processedRowsPerSecond") or 0.0),
        (d.get("eventTime") or {}).get("watermark"),
        sum(o.get("numRowsTotal", 0) for o in ops),
        sum(o.get("numRowsDroppedByWatermark", 0) for o in ops),
    )


def progress_rows(query: StreamingQuery) -> list[tuple]:
    return [progress_row(p) for p in query.recentProgress]


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    return spark.createDataFrame(progress_rows(query), PROGRESS_SCHEMA)


def run_progress(progress: DataFrame) -> DataFrame:
    """input_rows, dropped_by_watermark (sums), state_rows and watermark (of the last
    batch): one row, zeros and no watermark before the first update. A batch that
    reports again counts by its greater figures."""
    batches = progress.groupBy("batch_id").agg(
        *[F.max(c).alias(c) for c in ("num_input_rows", "dropped_by_watermark")], F.max_by(F.struct("state_rows", "watermark"), "timestamp").alias("last")
    )
    newest = F.max_by("last", "batch_id")
    return batches.agg(
        F.coalesce(F.sum("num_input_rows"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("dropped_by_watermark"), F.lit(0)).alias("dropped_by_watermark"),
        F.coalesce(newest["state_rows"], F.lit(0)).alias("state_rows"),
        F.to_timestamp(newest["watermark"]).alias("watermark"),
    )


class ProgressLog(StreamingQueryListener):
    """Register with ``spark.streams.addListener``. Every ``every`` updates, and
    when a query ends, the rows held are appended to Parquet at ``path``."""

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every, self.held = spark, path, every, []

    def flush(self) -> None:
        rows, self.held = self.held, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.held.append(progress_row(event.progress))
        if len(self.held) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
