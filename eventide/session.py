"""Session construction and the few session settings the semantics rely on."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings the results depend on (UTC: window_start/window_end are TIMESTAMPTZ
# in the summary table) plus scale settings: AQE coalesces the small post-
# aggregation shuffles and splits skewed partitions at runtime; RocksDB keeps
# window state off-heap so state size is bounded by disk, not executor heap.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Stored intermediate results go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # A long-lived driver (a streaming job, a report service) keeps plan
    # graphs of past executions in its status store; keep that bounded.
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
    "spark.sql.streaming.ui.retainedQueries": "20",
}


def build_session(
    master: str | None = None,
    app_name: str = "eventide",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


TIME_ZONE = "spark.sql.session.timeZone"


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds inside, and is what it was after."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextlib.contextmanager
def utc(spark: SparkSession) -> Iterator[None]:
    """The session's time zone is UTC inside, and the caller's again after.

    Expressions take the zone when a DataFrame is made, so a plan made inside
    keeps UTC wherever it runs later."""
    with setting(spark, TIME_ZONE, "UTC"):
        yield


def in_utc(make: Callable) -> Callable:
    """A query function (spark, ...) that makes its plan in UTC."""

    @functools.wraps(make)
    def made(spark: SparkSession, *args, **kwargs):
        with utc(spark):
            return make(spark, *args, **kwargs)

    return made


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, for sink output, checkpoints and
    stream state: ``spark.checkpoint.dir``, else the context's checkpoint
    folder, else a folder below ``spark.sql.warehouse.dir``. It becomes the
    context's checkpoint folder if that has none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    root = root or sc.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """``df`` stored once in the shared folder (``checkpoint``). Spark's cleaner
    removes it with the last reference where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this package has made, on whatever file system it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder on whatever file system it is; none if it isn't there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def move_into(spark: SparkSession, source: str, target: str) -> None:
    """Move the files of the folders in ``source`` into the same folders of ``target``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in listed(spark, source):
        for name in listed(spark, f"{source}/{folder}"):
            if folder[:1] not in "._" and name[:1] not in "._":
                fs.mkdirs(path(f"{target}/{folder}"))
                fs.rename(path(f"{source}/{folder}/{name}"), path(f"{target}/{folder}/{name}"))
