"""Sharding by weighted rendezvous hashing (operator 3), DataFrame functions only.

A record scores every shard by ``weight / -ln(u)``, where u in (0, 1) comes from
the md5 of "key:shard", and goes to the highest score. The key alone decides;
a new shard can only win records for itself, and a shard that leaves gives up
only its own. No row moves to find its shard: the score is one projection.

Slots number the records of a shard from 0 without gaps, in the order of the
md5 of their key (ties: doc_id, size, crc). They are numbered by bucket and
shifted (``shared.numbered``): no task holds a shard.

``stored_order`` numbers them in the order they are stored in instead: by Parquet
file, then row. A file's rows of one shard are the most that a task numbers.

Key: doc_id as text. A null doc_id takes the md5 of its text as key. Null
texts have size 8 and crc 0. Rows that repeat a doc_id share its shard and get
slots of their own. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import numbered, numbered_by

#: Hex digits of an md5 that make a number; 2**(4 * DIGITS) fits a double exactly.
DIGITS = 13
RANGE = 1 << (4 * DIGITS)


def hash_number(key: Column) -> Column:
    """A uniform number below RANGE from the md5 of a text; any engine can repeat it."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGITS), 16, 10).cast("long")


def score(key: Column, shard: int, weight: float) -> Column:
    u = (hash_number(F.concat(key, F.lit(f":{shard}"))) + F.lit(0.5)) / F.lit(float(RANGE))
    return F.lit(float(weight)) / -F.ln(u)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """struct(score, shard) of the winner; ties go to the higher shard number."""
    return F.array_max(F.array(*[F.struct(score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]))


def stored_place(docs: DataFrame) -> list[Column]:
    """File number, file and row of rows read from Parquet; nothing for other rows."""
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        docs.select(file, row).schema  # noqa: B018
    except AnalysisException:
        return []
    number = F.regexp_extract(file, r"part-(\d+)", 1).try_cast("long")
    return [F.coalesce(number, F.lit(-1)).alias("_number"), file.alias("_file"), row.alias("_at")]


def sharded(docs: DataFrame, weights: Sequence[float], grown_weight: float | None = None, id_column: str = "doc_id", text: str = "text",
            stored_order: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (the shard once one
    more of ``grown_weight`` is there): one row per row of ``docs``."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("text:"), F.md5(body.cast("binary"))))
    rows = docs.select(
        F.col(id_column).alias("_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        key.alias("_key"),
        *(where := stored_place(docs) if stored_order else []),
    )
    best = rendezvous(F.col("_key"), weights)
    grown = score(F.col("_key"), len(weights), weights[-1] if grown_weight is None else grown_weight)
    dealt = rows.withColumn("_best", best).select(
        "_id", "size", "text_crc32", F.col("_best.shard").alias("shard"),
        F.when(grown > F.col("_best.score"), F.lit(len(weights))).otherwise(F.col("_best.shard")).alias("grown_shard"),
        hash_number(F.col("_key")).alias("_place"), *(["_number", "_file", "_at"] if where else []),
    )
    if where:
        placed = numbered_by(dealt, ["shard"], ["_number", "_file"], ["_at"], "slot")
    else:
        placed = numbered(dealt, ["shard"], "_place", RANGE, ["_id", "size", "text_crc32"], "slot")
    return placed.select(
        F.col("_id").alias(id_column), "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"), "slot", F.col("grown_shard").cast("int")
    )
