"""Distributed synthetic click events.

Each output row is a pure function of its id: uniform category, event type
60/25/15, a product of the category, a price drawn uniformly in whole cents
from the category's range (0.0 unless the event is a purchase), zero-padded
user/session ids and event time = start + id x spacing. The id column may come
from ``spark.range`` or from any table, so the rows do not depend on how the
input is partitioned and generation scales with the executors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..constants import (
    CATEGORIES,
    EVENT_TYPES,
    EVENT_WEIGHTS_PCT,
    PRICE_RANGES,
    PRODUCT_NUMBERS,
    PRODUCTS,
    SESSION_COUNT,
    USER_COUNT,
)
from ..functions.hashing import hash_select_items
from ..functions.text import sql_list, zero_pad_sql

# Per-column salts of the row hash.
SALTS = {
    "h_category": 0x2545F491,
    "h_type": 0x6C8E9CF5,
    "h_product": 0x1F83D9AB,
    "h_number": 0x5BE0CD19,
    "h_user": 0x3C6EF372,
    "h_session": 0x510E527F,
    "h_price": 0x7137449B,
}

DEFAULT_START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
DEFAULT_SPACING_US = 100_000  # 10 events per second

OUTPUT_COLUMNS = (
    "event_id", "user_id", "session_id", "product_id", "category",
    "event_type", "amount", "timestamp", "event_time",
)


def event_type_sql(bucket: str) -> str:
    parts, upper = [], 0
    for name, pct in zip(EVENT_TYPES[:-1], EVENT_WEIGHTS_PCT[:-1]):
        upper += pct
        parts.append(f"WHEN {bucket} < {upper} THEN '{name}'")
    return f"CASE {' '.join(parts)} ELSE '{EVENT_TYPES[-1]}' END"


def generator_select_items(start: dt.datetime, spacing_us: int) -> list[str]:
    """Spark SQL select items over the hash columns (lateral aliases)."""
    cats = f"array({sql_list(CATEGORIES)})"
    prods = "array(" + ", ".join(f"array({sql_list(PRODUCTS[c])})" for c in CATEGORIES) + ")"
    lows = f"array({sql_list([PRICE_RANGES[c][0] * 100 for c in CATEGORIES])})"
    spans = f"array({sql_list([(PRICE_RANGES[c][1] - PRICE_RANGES[c][0]) * 100 + 1 for c in CATEGORIES])})"
    start_us = int(start.timestamp() * 1_000_000)
    return [
        "event_id",
        f"concat('user_', {zero_pad_sql(f'h_user % {USER_COUNT} + 1', 4)}) AS user_id",
        f"concat('sess_', {zero_pad_sql(f'h_session % {SESSION_COUNT} + 1', 4)}) AS session_id",
        f"CAST(h_category % {len(CATEGORIES)} + 1 AS INT) AS _ci",
        f"element_at({cats}, _ci) AS category",
        f"concat_ws('_', category, element_at(element_at({prods}, _ci), CAST(h_product % 5 + 1 AS INT)), "
        f"{zero_pad_sql(f'h_number % {PRODUCT_NUMBERS} + 1', 3)}) AS product_id",
        f"{event_type_sql('h_type % 100')} AS event_type",
        f"IF(event_type = 'purchase', CAST(element_at({lows}, _ci) + h_price % element_at({spans}, _ci) AS DOUBLE) / 100, 0.0D) AS amount",
        f"timestamp_micros({start_us} + event_id * {spacing_us}) AS event_time",
        "date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx\") AS timestamp",
    ]


def synthetic_events(
    ids: DataFrame,
    id_col: str = "id",
    start: dt.datetime = DEFAULT_START,
    spacing_us: int = DEFAULT_SPACING_US,
) -> DataFrame:
    """Typed wire events (+ ``event_id`` and ``event_time``) for every id."""
    hashed = ids.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS event_id", *hash_select_items("event_id", SALTS))
    return hashed.selectExpr(*generator_select_items(start, spacing_us)).select(*OUTPUT_COLUMNS)


def generate_events(spark: SparkSession, n: int, partitions: int | None = None, **kwargs) -> DataFrame:
    """``n`` events from ``spark.range`` (ids 0..n-1) in ``partitions`` slices."""
    return synthetic_events(spark.range(0, n, numPartitions=partitions), "id", **kwargs)
