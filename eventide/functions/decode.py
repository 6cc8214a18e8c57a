"""Tolerant JSON decode of wire events.

Semantics (missing field -> NULL; malformed row skipped; bad field -> NULL):

* every field is read as STRING with a corrupt-record column, so a bad field
  never marks the whole row corrupt; ``amount`` is ``try_cast`` to DOUBLE;
* a row is rejected when the text is not a JSON object (``_corrupt`` set) or
  is empty/NULL (``from_json`` returns a NULL struct without ``_corrupt``);
* ``event_time`` is NULL when the timestamp text does not parse; such rows
  stay in the decoded frame but belong to no window.

``from_json`` is evaluated once: the struct goes through ``inline(array(...))``
(a Generate node), which stops Catalyst from copying the parse into every
filter and projection that reads a field of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EVENT_TIME_PATTERN
from ..schema import CORRUPT_COLUMN, WIRE_DECODE_SCHEMA

REJECT_COLUMN = "_reject"
RAW_COLUMN = "_value"
REJECT_EMPTY = "empty"
REJECT_CORRUPT = "corrupt"

# Exactly six fraction digits and an offset (Z or +hh:mm), as the job's
# formatter requires; Spark's own parser would also take fewer digits. Checked
# by position, for text the pattern parses (fixed-width fields, so the fraction
# starts after character 20): "." at 20, then 6 digits and "Z" (27 chars) or a
# sign at 27 and "hh:mm" (32 chars).
STRICT_TIME_POSITIONS_SQL = (
    "(substr({c}, 20, 1) = '.' AND ((length({c}) = 27 AND substr({c}, 27, 1) = 'Z') "
    "OR (length({c}) = 32 AND substr({c}, 27, 1) IN ('+', '-'))))"
)


def event_time_sql(text_col: str, strict: bool = True) -> str:
    """``parse_event_time`` as Spark SQL text."""
    if not strict:
        return f"try_cast({text_col} AS TIMESTAMP)"
    shape = STRICT_TIME_POSITIONS_SQL.format(c=text_col)
    return f"CASE WHEN {shape} THEN try_to_timestamp({text_col}, \"{EVENT_TIME_PATTERN}\") END"


def _strict_shape(text: Column) -> Column:
    """Column form of ``STRICT_TIME_POSITIONS_SQL``."""
    n = F.length(text)
    offset_char = F.substring(text, 27, 1)
    return (F.substring(text, 20, 1) == F.lit(".")) & (
        ((n == 27) & (offset_char == F.lit("Z"))) | ((n == 32) & offset_char.isin("+", "-"))
    )


def parse_event_time(text: Column, strict: bool = True) -> Column:
    """ISO-8601 text -> TIMESTAMP (instant), NULL when it does not parse."""
    if not strict:
        return text.try_cast("timestamp")
    parsed = F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERN))
    return F.when(_strict_shape(text), parsed)


_DECODE_OPTIONS = f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{CORRUPT_COLUMN}')"


def decode_records(records: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """All input rows, decoded: ``keep`` columns, raw text, the seven string
    fields, ``_corrupt`` and ``_reject`` (NULL for accepted rows)."""
    passthrough = [f"`{c}`" for c in keep if c in records.columns]
    raw = f"CAST(`{value_col}` AS STRING)"
    parsed = f"from_json({raw}, '{WIRE_DECODE_SCHEMA.simpleString()}', {_DECODE_OPTIONS})"
    exploded = records.selectExpr(*passthrough, f"{raw} AS {RAW_COLUMN}", f"inline(array({parsed}))")
    reject = (
        f"CASE WHEN {RAW_COLUMN} IS NULL OR length(trim({RAW_COLUMN})) = 0 THEN '{REJECT_EMPTY}' "
        f"WHEN {CORRUPT_COLUMN} IS NOT NULL THEN '{REJECT_CORRUPT}' END AS {REJECT_COLUMN}"
    )
    return exploded.selectExpr("*", reject)


def valid_events(decoded: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Accepted rows as typed events (amount DOUBLE, event_time TIMESTAMP)."""
    return decoded.where(f"{REJECT_COLUMN} IS NULL").selectExpr(
        *[f"`{c}`" for c in keep],
        "user_id",
        "session_id",
        "product_id",
        "category",
        "event_type",
        "try_cast(amount AS DOUBLE) AS amount",
        "`timestamp`",
        f"{event_time_sql('`timestamp`', strict)} AS event_time",
    )


def rejects(decoded: DataFrame, keep: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Rows skipped by the decoder, with the raw text and the reason."""
    cols = [F.col(c) for c in keep if c in decoded.columns]
    return decoded.where(F.col(REJECT_COLUMN).isNotNull()).select(
        *cols, F.col(RAW_COLUMN).alias("value"), F.col(REJECT_COLUMN).alias("reason")
    )
