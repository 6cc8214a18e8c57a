"""Kafka source and sink. Spark tracks consumed offsets in the query
checkpoint, so the consumer group only names the client; the start position
applies to a fresh checkpoint only. The Kafka connector package must be on the
classpath (``spark.jars.packages``); it is not bundled with PySpark."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig


def source_options(
    cfg: JobConfig,
    starting_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
    exact_group_id: bool = False,
    min_partitions: int | None = None,
    fail_on_data_loss: bool | None = None,
    flush_records: int | None = None,
    flush_delay: str = "5s",
) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": cfg.kafka_bootstrap,
        "subscribe": cfg.kafka_topic,
        "startingOffsets": starting_offsets or cfg.starting_offsets,
    }
    if cfg.kafka_group_id:
        # A fixed group id makes concurrent queries steal each other's
        # partitions; by default it is only used as the client-id prefix.
        opts["kafka.group.id" if exact_group_id else "groupIdPrefix"] = cfg.kafka_group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if flush_records:
        # A micro-batch starts with so many new records, or when ``flush_delay``
        # has passed since the last one: use it with a short trigger interval.
        opts["minOffsetsPerTrigger"] = str(flush_records)
        opts["maxTriggerDelay"] = flush_delay
    if min_partitions:
        # Split each topic partition's offset range over several tasks so the
        # JSON decode is not limited to one core per topic partition.
        opts["minPartitions"] = str(min_partitions)
    if fail_on_data_loss is not None:
        # False skips offsets that the topic has already dropped without a
        # word: leave it unset unless that loss is acceptable.
        opts["failOnDataLoss"] = "true" if fail_on_data_loss else "false"
    return opts


def sink_options(cfg: JobConfig) -> dict[str, str]:
    """Producer settings of the original: acks=all, 3 retries, no key."""
    return {
        "kafka.bootstrap.servers": cfg.kafka_bootstrap,
        "topic": cfg.kafka_topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def kafka_stream(spark: SparkSession, cfg: JobConfig, **kwargs) -> DataFrame:
    """Unbounded record stream (key, value, topic, partition, offset, ...)."""
    return spark.readStream.format("kafka").options(**source_options(cfg, **kwargs)).load()


def kafka_batch(spark: SparkSession, cfg: JobConfig, start: dict[int, int] | None = None, end: dict[int, int] | None = None) -> DataFrame:
    """Bounded read of the topic: per topic partition from ``start`` up to
    ``end`` (exclusive), or from the earliest to the latest offset. A few
    records need only ``end = {partition: first offset + n}``."""
    opts = source_options(cfg, starting_offsets="earliest")
    at = lambda offsets: json.dumps({cfg.kafka_topic: {str(p): o for p, o in sorted(offsets.items())}})
    if start:
        opts["startingOffsets"] = at(start)
    opts["endingOffsets"] = at(end) if end else "latest"
    return spark.read.format("kafka").options(**opts).load()


def sample_records(records: DataFrame, n: int = 5) -> DataFrame:
    """First n records by (partition, offset): a top-k. Give it rows that are
    not encoded yet and encode what it returns."""
    return records.orderBy("partition", "offset").limit(n)


def write_kafka(records: DataFrame, cfg: JobConfig) -> None:
    records.select(F.col("value").cast("string").alias("value")).write.format("kafka").options(**sink_options(cfg)).save()
