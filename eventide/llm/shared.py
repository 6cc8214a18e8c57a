"""Helpers of the operators: shared folder, checked broadcast, gapless numbers."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import kept, remove_folder, shared_dir

#: Rows a side may have to be broadcast; a wider side is joined by shuffle.
BROADCAST_ROWS = 50_000
ARROW_BYTES = str(8 << 20)


def lean(spark: SparkSession) -> None:
    """Arrow batches of ``ARROW_BYTES`` where the session has no setting of its
    own: whole texts are wide rows, and each task holds a batch on either
    side. No result depends on it."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if ``df`` has at most ``rows`` rows, else ``df``."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def numbered(df: DataFrame, key: Sequence[str], place: str, limit: int, ties: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... within each key by ``place`` (a uniform
    hash in 0..limit-1) and ``ties``, without gaps.

    A key's rows are cut into ranges of ``place``, numbered inside a range and
    shifted by the rows of the ranges before, so a key with a third of all
    rows is numbered by all tasks. The number of ranges follows the shuffle
    partitions and changes no number. Rows and offsets are hashed alike, so
    the offsets join without another shuffle of the rows."""
    spark = df.sparkSession
    cuts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_cut", F.floor(F.col(place) / F.lit(float(limit)) * cuts).cast("int"))
    return numbered_by(dealt, key, ["_cut"], [place, *ties], name).drop("_cut")


def numbered_by(df: DataFrame, key: Sequence[str], cut: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... within each key by ``cut`` and, among equal
    cuts, by ``order``. No task holds more than the rows of one key and cut."""
    cell = [*key, *cut]
    before = Window.partitionBy(*key).orderBy(*cut).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select(*cell, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = df.withColumn("_inside", F.row_number().over(Window.partitionBy(*cell).orderBy(*order)) - 1)
    number = (F.col("_before") + F.col("_inside")).cast("long").alias(name)
    return inside.join(offsets, cell).select(*df.columns, number)


class Scratch:
    """A folder of its own below the shared one for tables that only live inside a
    ``with`` block. Unlike a checkpoint, writing one runs its plan once."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.tables = spark, f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}", 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove_folder(self.spark, self.path)

    def written(self, df: DataFrame) -> DataFrame:
        """``df``, written as Parquet and read again."""
        self.tables += 1
        path = f"{self.path}/{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def one_thread() -> None:
    """Let matrix products of this process run in one thread. Tasks run side by
    side, one a core, so threads of their own only wait for one another; on
    small matrices that takes as much time again as the work. numpy has no call
    for it, so the OpenBLAS that it has loaded is asked; without one, nothing
    changes. No result depends on it."""
    import ctypes

    cache = worker_cache()
    if "one_thread" in cache:
        return
    cache["one_thread"] = True
    try:
        with open("/proc/self/maps", encoding="utf-8") as f:
            paths = {line.split()[-1] for line in f if "openblas" in line}
        for path in sorted(paths):
            library = ctypes.CDLL(path)
            for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
                if hasattr(library, name):
                    getattr(library, name)(1)
    except OSError:
        pass


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python process (worker or driver)."""
    name = "eventide_llm_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].items = {}
    return sys.modules[name].items


__all__ = ["Scratch", "kept", "lean", "numbered", "numbered_by", "one_thread", "remove_folder", "shared_dir", "small", "worker_cache"]
