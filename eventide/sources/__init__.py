"""Sources: Kafka, files, JDBC and the test-data adapter."""

from .files import events_record_stream, events_stream, json_lines_stream, parquet_stream
from .kafka import kafka_batch, kafka_stream, sample_records, sink_options, source_options, write_kafka
from .jdbc import jdbc_properties, read_summary_jdbc
from .testdata import events_as_records, events_to_typed, events_to_wire, read_table

__all__ = [
    "events_record_stream",
    "events_stream",
    "json_lines_stream",
    "parquet_stream",
    "kafka_batch",
    "kafka_stream",
    "sample_records",
    "sink_options",
    "source_options",
    "write_kafka",
    "jdbc_properties",
    "read_summary_jdbc",
    "events_as_records",
    "events_to_typed",
    "events_to_wire",
    "read_table",
]
