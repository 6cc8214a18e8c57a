"""Deterministic dirty and NULL inputs derived from the events table.

Every row of the table is processed; ``event_id mod 11`` only decides which
defect a row's wire text carries, so the same rule can be written in SQL:

  1 broken JSON (corrupt)      6 ``[]`` (corrupt)
  2 amount "x" (NULL amount)   7 amount as a quoted number (same amount)
  3 no category (NULL)         8 ``null`` (corrupt)
  4 time without fraction      9 amount ``true`` (NULL amount)
    (NULL event time)         10 user_id as an object (kept as its JSON text)
  5 empty text (empty)         0 unchanged
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import WIRE_FIELDS

DIRTY_MOD = 11


def _json(**override: Column | None) -> Column:
    cols = []
    for f in WIRE_FIELDS:
        c = override[f] if f in override else F.col(f)
        if c is not None:
            cols.append(c.alias(f))
    return F.to_json(F.struct(*cols))


def dirty_records(wire: DataFrame) -> DataFrame:
    """Kafka-shaped records (partition, offset, value) with defects by id."""
    m = F.pmod(F.col("event_id"), F.lit(DIRTY_MOD))
    value = (
        F.when(m == 1, F.concat(F.lit("{bad json "), F.col("event_id").cast("string")))
        .when(m == 2, _json(amount=F.lit("x")))
        .when(m == 3, _json(category=None))
        .when(m == 4, _json(timestamp=F.regexp_replace(F.col("timestamp"), r"\.\d{6}", "")))
        .when(m == 5, F.lit(""))
        .when(m == 6, F.lit("[]"))
        .when(m == 7, _json(amount=F.col("amount").cast("string")))
        .when(m == 8, F.lit("null"))
        .when(m == 9, _json(amount=F.lit(True)))
        .when(m == 10, _json(user_id=F.struct(F.lit(1).alias("a"))))
        .otherwise(_json())
    )
    return wire.select("partition", "offset", value.alias("value"))


def null_amounts(wire: DataFrame, category: str = "books", every: int = 5) -> DataFrame:
    """NULL amount for every ``every``-th event and for all of one category."""
    drop = (F.pmod(F.col("event_id"), F.lit(every)) == 0) | (F.col("category") == F.lit(category))
    return wire.withColumn("amount", F.when(~drop, F.col("amount")))
