"""Wire encoding: typed event columns -> one JSON object per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import WIRE_TIME_FORMAT
from ..schema import WIRE_FIELDS


def iso_utc(ts: Column) -> Column:
    """TIMESTAMP -> ``2024-01-01T00:00:01.123456+00:00`` (session zone UTC)."""
    return F.date_format(ts, WIRE_TIME_FORMAT)


def wire_json(prefix: str | None = None) -> Column:
    """JSON text of the seven wire fields; NULL fields are left out, which the
    decoder reads back as missing -> NULL."""
    cols = [F.col(f"{prefix}.{f}" if prefix else f).alias(f) for f in WIRE_FIELDS]
    return F.to_json(F.struct(*cols))


def encode_records(events: DataFrame, keep: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Typed wire rows -> Kafka-shaped rows with a JSON ``value`` (no key: the
    original producer sends unkeyed records)."""
    passthrough = [F.col(c) for c in keep if c in events.columns]
    return events.select(*passthrough, wire_json().alias("value"))
