"""Decode-quality counters: the rows the tolerant decoder skips or weakens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import REJECT_COLUMN, REJECT_CORRUPT, REJECT_EMPTY, parse_event_time


def quality_counters(strict: bool = True) -> list[Column]:
    """The seven counters as aggregates over ``decode_records`` output, for a
    batch aggregate or for ``observe`` on a stream."""
    accepted = F.col(REJECT_COLUMN).isNull()
    amount = F.col("amount")
    counters = {
        "total_records": F.lit(True),
        "accepted_records": accepted,
        "corrupt_records": F.col(REJECT_COLUMN) == F.lit(REJECT_CORRUPT),
        "empty_records": F.col(REJECT_COLUMN) == F.lit(REJECT_EMPTY),
        "null_event_time": accepted & parse_event_time(F.col("timestamp"), strict).isNull(),
        "null_category": accepted & F.col("category").isNull(),
        "bad_amount": accepted & amount.isNotNull() & amount.try_cast("double").isNull(),
    }
    return [F.count_if(c).alias(name) for name, c in counters.items()]


def decode_quality(decoded: DataFrame, strict: bool = True) -> DataFrame:
    """One row over all decoded records (output of ``decode_records``)."""
    return decoded.agg(*quality_counters(strict))
