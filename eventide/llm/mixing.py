"""Mixing sources to target weights by Pfair scheduling (operator 8), DataFrame
functions only.

Every source is a stream of blocks. Block j (from 1) of a stream with weight
p of P in all is released at slot floor((j - 1) P / p) and due at slot
ceil(j P / p). Each slot goes to the released block with the earliest
deadline (ties: the stream listed first). Such windows can always be met, so
at any slot t a stream has had less than one block more or less than t p / P.

The schedule repeats after P slots, each stream having p of them. One period
(P rows: the weights' sum, a parameter, at most MAX_PERIOD) is folded by one
higher-order ``aggregate``; block j of any stream then has its slot by
arithmetic. Rows are numbered within their stream by hash (``shared.numbered``)
and their place in the whole output follows in closed form: for every stream,
the blocks before a slot, at most all its rows. So no task holds a stream.

Every row comes out exactly once. A stream that has run out leaves its slots
empty, the others keep theirs: the bound holds for each stream until it ends.
Sources without a weight, null among them, share the last stream
(``other_weight``). Null texts don't matter. Rows that repeat a doc_id are
numbered one by one. Extra columns are kept by ``mixed_rows`` and not read by
``mixing_plan``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import numbered
from .sharding import RANGE, hash_number

BLOCK_ROWS = 16
MAX_PERIOD = 100_000
#: Production weights: the hot source is cut to 24 of 104, the others have 4 each.
WEIGHTS = {"src0": 24} | {f"src{i}": 4 for i in range(1, 20)}
OTHER_WEIGHT = 4


def schedule(spark: SparkSession, weights: list[int]) -> DataFrame:
    """One period: stream, turn (0.. within the stream), slot, before (blocks of
    each stream before the slot). As many rows as the weights' sum."""
    period = sum(weights)
    if not 0 < period <= MAX_PERIOD or min(weights) < 1:
        raise ValueError(f"weights are whole numbers from 1, {MAX_PERIOD} in all at most")
    p = F.array(*[F.lit(w).cast("long") for w in weights])
    none = F.array(*[F.lit(0).cast("long") for _ in weights])
    entry = "array<struct<stream: int, turn: bigint, slot: int, before: array<bigint>>>"
    start = F.struct(none.alias("had"), F.array().cast(entry).alias("slots"))

    def deadline(had: Column, weight: Column, slot: Column) -> Column:
        release = F.floor(had * period / weight)
        return F.when(release <= slot, F.ceil((had + 1) * period / weight))

    def step(state: Column, slot: Column) -> Column:
        had = state["had"]
        due = F.transform(had, lambda h, i: F.struct(deadline(h, F.get(p, i), slot).alias("due"), i.cast("int").alias("i")))
        pick = F.array_min(F.filter(due, lambda x: x["due"].isNotNull()))["i"]
        row = F.struct(pick.alias("stream"), F.get(had, pick).alias("turn"), slot.cast("int").alias("slot"), had.alias("before"))
        return F.struct(F.transform(had, lambda h, i: h + (i == pick).cast("long")).alias("had"), F.concat(state["slots"], F.array(row)).alias("slots"))

    folded = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step, lambda state: state["slots"])
    return spark.range(1).select(F.inline(folded))


def mixing_plan(docs: DataFrame, weights: Mapping[str, int], other_weight: int, block_rows: int = BLOCK_ROWS,
                id_column: str = "doc_id", source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, doc_id, source, stream, block, slot, position: one row per row
    of ``docs``; ordered by position they are the mixture."""
    spark = docs.sparkSession
    names, parts = list(weights), [*weights.values(), other_weight]
    period = sum(parts)
    known = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
    rows = docs.select(*[F.col(c) for c in keep], F.col(id_column).alias("_id"), F.col(source).alias("_source"))
    rows = rows.withColumn("stream", F.coalesce(known[F.col("_source")], F.lit(len(names))))
    rows = rows.withColumn("_place", hash_number(F.coalesce(F.col("_id").cast("string"), F.lit("null"))))
    placed = numbered(rows, ["stream"], "_place", RANGE, ["_id"], "_index")

    # One number per stream, so bounded by the weights given.
    total = {r["stream"]: r["count"] for r in rows.groupBy("stream").count().collect()}
    turns = schedule(spark, parts).withColumnsRenamed({"stream": "_stream", "turn": "_turn", "slot": "_slot", "before": "_before_slot"})

    share = F.element_at(F.array(*[F.lit(p).cast("long") for p in parts]), F.col("stream") + 1)
    placed = placed.withColumn("block", F.floor(F.col("_index") / block_rows).cast("long"))
    placed = placed.withColumn("_cycle", F.floor(F.col("block") / share).cast("long")).withColumn("_turn", F.pmod(F.col("block"), share))
    same = (F.col("stream") == F.col("_stream")) & (F.col("a._turn") == F.col("b._turn"))
    # A period has at most MAX_PERIOD rows, whatever the data.
    dealt = placed.alias("a").join(F.broadcast(turns).alias("b"), same)
    before = F.lit(0).cast("long")
    for i, p in enumerate(parts):
        blocks = F.col("_cycle") * p + F.get("_before_slot", F.lit(i))
        before = before + F.least(blocks * block_rows, F.lit(total.get(i, 0)))
    return dealt.select(
        *[F.col(c) for c in keep], F.col("_id").alias(id_column), F.col("_source").alias(source), F.col("stream").cast("int"), "block",
        (F.col("_cycle") * period + F.col("_slot")).cast("long").alias("slot"),
        (before + F.pmod(F.col("_index"), F.lit(block_rows))).cast("long").alias("position"),
    )


def mixed_rows(docs: DataFrame, weights: Mapping[str, int], other_weight: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` in mixed order: partitions follow one another by position, and
    so do the files they are written to."""
    whole = docs.select("doc_id", "source", F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    plan = mixing_plan(whole, weights, other_weight, block_rows, keep=("_row",))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return plan.repartitionByRange(n, "position").sortWithinPartitions("position").select("_row.*")
