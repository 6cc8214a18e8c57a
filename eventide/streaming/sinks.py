"""Summary sinks.

``KeyedSummaryTable`` is the summary as plain Parquet with upsert-by-key
semantics: every micro-batch appends its rows, partitioned by window date and
tagged with a version, and a read takes the newest row of each key with one
``max_by``. A version is (run, batch id); a run is the moment its writer was
made, so what a resubmitted job writes from a fresh checkpoint, whose batch
ids begin at 0 again, is newer than all before it, key by key. A replayed
batch appends the same rows again and changes nothing. Rows whose key is NULL,
or occurs twice in a batch, are kept beside the others with the reason and
read as rejects.

``JdbcUpsertSink`` has the same contract against a database: executors write
the batch to staging tables in parallel, then one transaction upserts the rows
(``INSERT .. ON CONFLICT`` on PostgreSQL, ``MERGE`` elsewhere) and replaces the
batch's rejects. The driver sends statements, never rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SUMMARY_KEY, SUMMARY_SCHEMA
from ..session import listed, remove_folder, utc

VALUE_COLUMNS = tuple(f.name for f in SUMMARY_SCHEMA.fields if f.name not in SUMMARY_KEY)
ALL_COLUMNS = tuple(f.name for f in SUMMARY_SCHEMA.fields)
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def with_defaults(batch: DataFrame) -> DataFrame:
    """Column defaults of the summary table: counts 0, revenue 0.0."""
    return batch.select(
        "window_start",
        "window_end",
        "category",
        F.coalesce(F.col("event_count"), F.lit(0)).cast("bigint").alias("event_count"),
        F.coalesce(F.col("purchase_count"), F.lit(0)).cast("bigint").alias("purchase_count"),
        F.coalesce(F.col("total_revenue"), F.lit(0.0)).cast("double").alias("total_revenue"),
    )


def key_is_valid(key: Sequence[str] = SUMMARY_KEY):
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(k).isNotNull()
    return cond


NULL_KEY, DUPLICATE_KEY = "null key", "duplicate key"


def with_reasons(batch: DataFrame, key: Sequence[str] = SUMMARY_KEY) -> DataFrame:
    """``batch`` with ``reason``: why a row breaks the key's constraints, else NULL.
    A key that a batch has more than once is as good as none, so all its
    rows break the constraint; a batch has one row a key by its aggregate."""
    times = F.count(F.lit(1)).over(Window.partitionBy(*key))
    return batch.withColumn("reason", F.when(~key_is_valid(key), NULL_KEY).when(times > 1, DUPLICATE_KEY))


class RejectLog:
    """Rejected records as Parquet below ``path``, in one folder a batch; usable
    directly as a ``foreachBatch`` function. A batch that runs again replaces
    its folder. One log belongs to one checkpoint, which numbers its batches."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={int(batch_id)}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", self.path).parquet(self.path)


class KeyedSummaryTable:
    """Parquet below ``path``, partitioned by ``window_date``; usable directly as
    a ``foreachBatch`` function.

    ``run`` orders writers: by default the time of making this object, in
    microseconds. Jobs that write one table follow one another; their clocks
    must not go back between them."""

    stored = T.StructType([
        *(T.StructField(f.name, f.dataType, True) for f in SUMMARY_SCHEMA.fields),
        T.StructField("reason", T.StringType(), True),
        T.StructField("run", T.LongType(), True), T.StructField("batch_id", T.LongType(), True), T.StructField("window_date", T.DateType(), True),
    ])

    def __init__(self, path: str, run: int | None = None):
        self.path = path.rstrip("/")
        self.run = time.time_ns() // 1000 if run is None else run

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with utc(batch.sparkSession):
            rows = with_reasons(with_defaults(batch)).select(
                "*",
                F.lit(int(self.run)).cast("bigint").alias("run"),
                F.lit(int(batch_id)).cast("bigint").alias("batch_id"),
                F.to_date("window_start").alias("window_date"),
            )
            # One file a date at most: a micro-batch holds a handful of closed windows.
            rows.repartition("window_date").write.mode("append").partitionBy("window_date").parquet(self.path)

    def versions(self, spark: SparkSession) -> DataFrame:
        """All rows ever written; none before the first write."""
        try:
            return spark.read.schema(self.stored).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.stored)

    def newest(self, spark: SparkSession, dates: Sequence[str] | None = None) -> DataFrame:
        """The newest row of every key, with its version. The date belongs to the
        key, so a filter on it prunes the scan; ``dates`` is one such filter."""
        rows = self.versions(spark).where(F.col("reason").isNull() & key_is_valid())
        if dates is not None:
            rows = rows.where(F.col("window_date").isin([dt.date.fromisoformat(d) for d in dates]))
        values = F.struct(*VALUE_COLUMNS, "run", "batch_id")
        rows = rows.groupBy("window_date", *SUMMARY_KEY).agg(F.max_by(values, F.struct("run", "batch_id")).alias("_row"))
        row = {c: F.col(f"_row.{c}").alias(c) for c in (*VALUE_COLUMNS, "run", "batch_id")}
        return rows.select(*[row.get(c, F.col(c)) for c in (*ALL_COLUMNS, "run", "batch_id", "window_date")])

    def newest_rejects(self, spark: SparkSession) -> DataFrame:
        """Rows that broke the key's constraints: of each key those of the newest batch, once each."""
        reason = F.coalesce("reason", F.when(~key_is_valid(), NULL_KEY)).alias("reason")
        rows = self.versions(spark).select(*ALL_COLUMNS, reason, "run", "batch_id", "window_date").where("reason is not null")
        order = Window.partitionBy("window_date", *SUMMARY_KEY).orderBy(F.desc("run"), F.desc("batch_id"))
        return rows.dropDuplicates().withColumn("_age", F.rank().over(order)).where("_age = 1").drop("_age")

    def read(self, spark: SparkSession, dates: Sequence[str] | None = None) -> DataFrame:
        """The current table, with ``window_date`` to filter by."""
        return self.newest(spark, dates).select(*ALL_COLUMNS, "window_date")

    def read_rejects(self, spark: SparkSession) -> DataFrame:
        return self.newest_rejects(spark).select(*ALL_COLUMNS, "reason")

    def dates(self, spark: SparkSession) -> list[str]:
        """The dates that have rows, newest first, from the folder's listing alone."""
        names = [n.partition("=")[2] for n in listed(spark, self.path) if n.startswith("window_date=")]
        return sorted((n for n in names if n != NO_DATE), reverse=True)

    def files(self, spark: SparkSession, date: str) -> list[str]:
        return [n for n in listed(spark, f"{self.path}/window_date={date}") if not n.startswith((".", "_"))]

    def latest(self, spark: SparkSession, n: int = 10) -> DataFrame:
        """The rows of the newest dates that hold the ``n`` newest rows: dates are
        added newest first, twice as many each time, until they have ``n``.
        Rows of other dates are older than all of these, so no other file is read."""
        dates, taken = self.dates(spark), 0
        while True:
            taken = min(len(dates), max(1, 2 * taken))
            rows = self.read(spark, dates[:taken])
            if taken == len(dates) or rows.limit(n).count() >= n:
                return rows.drop("window_date")

    def compact(self, spark: SparkSession, since: str, until: str) -> None:
        """Keep only the newest rows of the dates from ``since`` to ``until``
        (inclusive). They are appended with their own versions first, then the
        files they came from are removed: a read is right at every moment,
        and a compaction that is lost half way has done no harm. Run it for
        dates that no job is writing to."""
        dates = [d for d in self.dates(spark) if since <= d <= until]
        old = [f"{self.path}/window_date={d}/{f}" for d in dates for f in self.files(spark, d)]
        self.append_newest(spark, dates)
        for path in old:
            remove_folder(spark, path)

    def append_newest(self, spark: SparkSession, dates: Sequence[str]) -> None:
        rejected = self.newest_rejects(spark).where(F.col("window_date").isin([dt.date.fromisoformat(d) for d in dates]))
        rows = self.newest(spark, dates).withColumn("reason", F.lit(None).cast("string")).unionByName(rejected)
        rows = rows.select(*self.stored.names).repartition("window_date")
        rows.write.mode("append").partitionBy("window_date").parquet(self.path)


class RevenueRollup:
    """Totals by date and category of a ``KeyedSummaryTable``, kept as Parquet below
    ``path``, partitioned by date. ``refresh`` rebuilds the dates whose files have
    changed since (a batch or a compaction touched them) and no others. Totals
    over all time add up these rows, a few a date."""

    def __init__(self, path: str, table: KeyedSummaryTable):
        self.path, self.table = path.rstrip("/"), table

    stored = "category string, event_count long, purchase_count long, total_revenue double, files string, window_date date"

    def read(self, spark: SparkSession) -> DataFrame:
        if not listed(spark, self.path):
            return spark.createDataFrame([], self.stored)
        return spark.read.schema(self.stored).parquet(self.path)

    def stale(self, spark: SparkSession) -> dict[str, str]:
        """Date -> mark of its files, where the rollup has another mark or none."""
        marks = {d: hashlib.md5("\n".join(self.table.files(spark, d)).encode()).hexdigest() for d in self.table.dates(spark)}
        built = {str(r["window_date"]): r["files"] for r in self.read(spark).select("window_date", "files").distinct().collect()}  # one row a date
        return {d: m for d, m in marks.items() if built.get(d) != m}

    def refresh(self, spark: SparkSession) -> list[str]:
        """Bring the rollup up to date; returns the dates that were rebuilt."""
        stale = self.stale(spark)
        if stale:
            rows = self.table.read(spark, list(stale)).groupBy("window_date", "category").agg(
                *[F.sum(c).alias(c) for c in ("event_count", "purchase_count", "total_revenue")]
            )
            marks = spark.createDataFrame([(dt.date.fromisoformat(d), m) for d, m in stale.items()], "window_date date, files string")
            (
                rows.join(F.broadcast(marks), "window_date").repartition("window_date").select("category", "event_count", "purchase_count", "total_revenue", "files", "window_date")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_date").parquet(self.path)
            )
        return sorted(stale)


# ---------------------------------------------------------------------------
# JDBC upsert
# ---------------------------------------------------------------------------

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_.]*$")


def _q(name: str) -> str:
    return f'"{name}"'


def upsert_sql(url: str, table: str, staging: str, key: Sequence[str] = SUMMARY_KEY, columns: Sequence[str] = ALL_COLUMNS) -> str:
    """One statement that upserts all staging rows into ``table``."""
    for name in (table, staging):
        if not _IDENT.match(name):
            raise ValueError(f"bad table name {name!r}")
    cols = ", ".join(_q(c) for c in columns)
    values = [c for c in columns if c not in key]
    if url.startswith("jdbc:postgresql:"):
        sets = ", ".join(f"{_q(c)} = EXCLUDED.{_q(c)}" for c in values)
        return (
            f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} "
            f"ON CONFLICT ({', '.join(_q(k) for k in key)}) DO UPDATE SET {sets}"
        )
    on = " AND ".join(f"t.{_q(k)} = s.{_q(k)}" for k in key)
    sets = ", ".join(f"{_q(c)} = s.{_q(c)}" for c in values)
    ins = ", ".join(f"s.{_q(c)}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({ins})"
    )


def summary_ddl(url: str, table: str) -> str:
    """CREATE TABLE for the summary: NOT NULL key columns, zero defaults and
    the (window_start, category) primary key the upsert relies on."""
    return table_ddl(url, table)[0]


def table_ddl(url: str, table: str) -> list[str]:
    """The summary table, its indexes on window_start and on category, and the
    table of rejects (NULL keys, tagged with the run and batch they came in)."""
    if not _IDENT.match(table):
        raise ValueError(f"bad table name {table!r}")
    pg = url.startswith("jdbc:postgresql:")
    ts = "TIMESTAMPTZ" if pg else "TIMESTAMP"
    text = "TEXT" if pg else "VARCHAR(256)"
    cols = (
        f'"window_start" {ts} NOT NULL, "window_end" {ts} NOT NULL, "category" {text} NOT NULL, '
        '"event_count" BIGINT DEFAULT 0, "purchase_count" BIGINT DEFAULT 0, '
        '"total_revenue" DOUBLE PRECISION DEFAULT 0.0, '
        'PRIMARY KEY ("window_start", "category")'
    )
    exists = "IF NOT EXISTS " if pg else ""
    plain = table.replace(".", "_")
    rejected = cols.split(", PRIMARY KEY")[0].replace(" NOT NULL", "")
    return [
        f"CREATE TABLE {exists}{table} ({cols})",
        f'CREATE INDEX {exists}idx_{plain}_window ON {table} ("window_start" DESC)',
        f'CREATE INDEX {exists}idx_{plain}_category ON {table} ("category")',
        f'CREATE TABLE {exists}{table}_rejects ({rejected}, "run" {text}, "batch_id" BIGINT)',
    ]


def jvm_executor(spark: SparkSession, url: str, properties: dict[str, str]) -> Callable[[Sequence[str]], None]:
    """Runs statements in one transaction on the driver's JDBC connection."""

    def run(statements: Sequence[str]) -> None:
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in properties.items():
            props.setProperty(k, v)
        conn = jvm.java.sql.DriverManager.getConnection(url, props)
        try:
            conn.setAutoCommit(False)
            stmt = conn.createStatement()
            for s in statements:
                stmt.execute(s)
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            conn.close()

    return run


class JdbcUpsertSink:
    def __init__(
        self,
        url: str,
        table: str,
        properties: dict[str, str],
        query_tag: str = "q",
        batch_size: int = 100,
        execute: Callable[[Sequence[str]], None] | None = None,
        max_connections: int = 8,
    ):
        if not _IDENT.match(query_tag):
            raise ValueError(f"bad query tag {query_tag!r}")
        self.url, self.table, self.properties = url, table, dict(properties)
        self.query_tag, self.batch_size, self._execute = query_tag, batch_size, execute
        self.max_connections = max_connections

    def ensure_table(self, spark: SparkSession) -> None:
        """Create tables and indexes if the database does not have them yet."""
        execute = self._execute or jvm_executor(spark, self.url, self.properties)
        execute(table_ddl(self.url, self.table))

    def staging_table(self, batch_id: int) -> str:
        return f"{self.table}_stage_{self.query_tag}_{int(batch_id)}"

    def statements(self, batch_id: int) -> list[str]:
        """One transaction: the upsert, and the batch's rejects in place of
        those that an earlier attempt at it has left."""
        staging, rejects = self.staging_table(batch_id), f"{self.table}_rejects"
        columns = ", ".join(_q(c) for c in (*ALL_COLUMNS, "run", "batch_id"))
        return [
            upsert_sql(self.url, self.table, staging),
            f"DELETE FROM {rejects} WHERE \"run\" = '{self.query_tag}' AND \"batch_id\" = {int(batch_id)}",
            f"INSERT INTO {rejects} ({columns}) SELECT {columns} FROM {staging}_rejects",
            f"DROP TABLE {staging}",
            f"DROP TABLE {staging}_rejects",
        ]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        execute = self._execute or jvm_executor(batch.sparkSession, self.url, self.properties)
        # numPartitions caps concurrent connections: the staging write is
        # coalesced to at most that many tasks, however wide the batch is.
        write_props = {**self.properties, "batchsize": str(self.batch_size), "numPartitions": str(self.max_connections)}
        staging = self.staging_table(batch_id)
        batch = batch.persist()
        try:
            valid = with_defaults(batch.where(key_is_valid()))
            valid.write.jdbc(self.url, staging, mode="overwrite", properties=write_props)
            bad = batch.where(~key_is_valid()).select(*ALL_COLUMNS, F.lit(self.query_tag).alias("run"), F.lit(int(batch_id)).cast("bigint").alias("batch_id"))
            bad.write.jdbc(self.url, f"{staging}_rejects", mode="overwrite", properties=write_props)
            execute(self.statements(batch_id))
        finally:
            batch.unpersist()


# ---------------------------------------------------------------------------
# Wire-record sinks (JSON lines / Kafka)
# ---------------------------------------------------------------------------

def write_json_lines(records: DataFrame, path: str, mode: str = "append") -> None:
    """Batch: one JSON record per line (the offline stand-in for a topic)."""
    records.select(F.col("value").cast("string").alias("value")).write.mode(mode).text(path)


def start_record_sink(records: DataFrame, checkpoint: str, kafka_options: dict[str, str] | None = None, path: str | None = None, trigger: dict | None = None):
    """Stream wire records to Kafka (``kafka_options`` from
    ``sources.kafka.sink_options``) or, offline, to JSON-lines files."""
    writer = (
        records.select(F.col("value").cast("string").alias("value"))
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
    )
    if kafka_options:
        return writer.format("kafka").options(**kafka_options).start()
    if not path:
        raise ValueError("give kafka_options or a path")
    return writer.format("text").option("path", path).start()
