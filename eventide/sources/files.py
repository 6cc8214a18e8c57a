"""File sources: JSON-lines record streams and parquet event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .testdata import events_as_records


def json_lines_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """One wire record per line, as a ``value`` column like the Kafka source.

    ``clean_source`` ("archive" with ``archive_dir``, or "delete") moves
    committed files out of the watched folder so its listing stays small on
    a stream that runs for months."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(path)


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream: ``path`` may be one file or a folder of
    part files. ``max_files_per_trigger`` bounds a micro-batch.

    The last character goes in as a pattern that matches only itself: as a
    pattern, a path may be a file, where a plain path must be a folder."""
    path = path.rstrip("/")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = 64) -> DataFrame:
    """The driver's events table as a file stream, at most 64 files a
    micro-batch unless told otherwise."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    return parquet_stream(spark, path, spark.read.parquet(path).schema, max_files_per_trigger)


def events_record_stream(spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    """The driver's events table as a stream of wire records."""
    return events_as_records(events_stream(spark, sf_dir, **kwargs))
