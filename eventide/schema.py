"""Declared schemas. No inference anywhere: wire, decoded event and summary."""

from __future__ import annotations

from pyspark.sql import types as T

WIRE_FIELDS = (
    "user_id",
    "session_id",
    "product_id",
    "category",
    "event_type",
    "amount",
    "timestamp",
)

CORRUPT_COLUMN = "_corrupt"

# Every wire field is decoded as STRING so that a bad *field* (e.g. "amount":"x")
# stays a NULL field instead of turning the whole row into a corrupt record.
# Typed conversion happens afterwards with try_cast / try_to_timestamp.
WIRE_DECODE_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in WIRE_FIELDS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Typed wire record as produced by the generator and encoded to JSON.
WIRE_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), True),
        T.StructField("session_id", T.StringType(), True),
        T.StructField("product_id", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("timestamp", T.StringType(), True),
    ]
)

EVENT_SCHEMA = T.StructType(
    list(WIRE_RECORD_SCHEMA.fields)
    + [T.StructField("event_time", T.TimestampType(), True)]
)

SUMMARY_KEY = ("window_start", "category")

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType(), False),
        T.StructField("window_end", T.TimestampType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("event_count", T.LongType(), True),
        T.StructField("purchase_count", T.LongType(), True),
        T.StructField("total_revenue", T.DoubleType(), True),
    ]
)
