"""Adapter from the driver's ``events`` table to Kafka-shaped wire records.

Mapping (the oracle SQL applies the same one):
``k = props.$.k``; category = CATEGORIES[k mod 7]; product_id =
``{category}_{PRODUCTS[category][(k div 7) mod 5]}_{k mod 50 + 1:03}``;
user_id = ``user_%04d``; session_id = ``sess_%04d`` of ``user_id mod 100 + 1``;
amount = value for purchases else 0.0; event_type unchanged; timestamp = ISO
text of ``ts`` read as UTC. Records are spread over ``partitions`` topic
partitions round robin by ``event_id`` with offset ``event_id div partitions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..constants import CATEGORIES, PRODUCTS, PURCHASE, SESSION_COUNT, WIRE_TIME_FORMAT
from ..functions.encode import encode_records
from ..functions.text import sql_list, zero_pad_sql

TOPIC_PARTITIONS = 3


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wire_select_items(partitions: int = TOPIC_PARTITIONS) -> list[str]:
    """Spark SQL select items mapping an ``events`` row to a wire record
    (intermediate ``_k``/``_ci`` use lateral column aliases)."""
    cats = f"array({sql_list(CATEGORIES)})"
    prods = "array(" + ", ".join(f"array({sql_list(PRODUCTS[c])})" for c in CATEGORIES) + ")"
    n = len(CATEGORIES)
    return [
        "try_cast(get_json_object(props, '$.k') AS INT) AS _k",
        f"CAST(pmod(_k, {n}) + 1 AS INT) AS _ci",
        f"CAST(pmod(event_id, {int(partitions)}) AS INT) AS `partition`",
        f"event_id div {int(partitions)} AS `offset`",
        "event_id",
        f"concat('sess_', {zero_pad_sql(f'pmod(user_id, {SESSION_COUNT}) + 1', 4)}) AS session_id",
        f"concat('user_', {zero_pad_sql('user_id', 4)}) AS user_id",
        f"element_at({cats}, _ci) AS category",
        f"concat_ws('_', category, element_at(element_at({prods}, _ci), CAST(pmod(_k div {n}, 5) + 1 AS INT)), "
        f"{zero_pad_sql('pmod(_k, 50) + 1', 3)}) AS product_id",
        "event_type",
        f"IF(event_type = '{PURCHASE}', value, 0.0D) AS amount",
        f"date_format(CAST(ts AS TIMESTAMP), \"{WIRE_TIME_FORMAT}\") AS `timestamp`",
    ]


WIRE_COLUMNS = ("partition", "offset", "event_id", "user_id", "session_id", "product_id",
                "category", "event_type", "amount", "timestamp")


def events_to_wire(events: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """partition, offset, event_id + the seven typed wire fields."""
    return events.selectExpr(*wire_select_items(partitions)).select(*WIRE_COLUMNS)


def events_to_typed(events: DataFrame) -> DataFrame:
    """The same mapping as typed events (``event_time`` TIMESTAMP), without
    the JSON wire step: the columnar path for inputs whose records are known
    to be well formed, such as a summary for reports."""
    return events.selectExpr(*wire_select_items(), "CAST(ts AS TIMESTAMP) AS event_time").select(
        *WIRE_COLUMNS, "event_time"
    )


def events_as_records(events: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Kafka-shaped rows (partition, offset, value) of the events table."""
    return encode_records(events_to_wire(events, partitions))
