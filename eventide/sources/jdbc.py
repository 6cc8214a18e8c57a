"""Partitioned JDBC scan of the summary table.

``window_start`` is the partition column: ``num_partitions`` range queries run
in parallel on the executors, and filters on it (the report's period filter)
are pushed into each query's WHERE clause.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_properties(user: str, password: str | None, driver: str | None = None, fetchsize: int = 10_000) -> dict[str, str]:
    props = {"user": user, "fetchsize": str(fetchsize)}
    if password is not None:
        props["password"] = password
    if driver:
        props["driver"] = driver
    return props


def window_bounds(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> tuple[str | None, str | None]:
    """min/max window_start, computed by the database (one row comes back)."""
    q = f'(SELECT MIN("window_start") AS "lo", MAX("window_start") AS "hi" FROM {table}) bounds'
    row = spark.read.jdbc(url, q, properties=properties).first()
    if row is None or row["lo"] is None:
        return None, None
    return str(row["lo"]), str(row["hi"])


def read_summary_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    lower_bound: str | None = None,
    upper_bound: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """The summary table as a DataFrame. With ``num_partitions`` the scan is
    split into that many ``window_start`` ranges read in parallel; bounds
    default to the table's min/max (asked of the database)."""
    if num_partitions and num_partitions > 1:
        if lower_bound is None or upper_bound is None:
            lo, hi = window_bounds(spark, url, table, properties)
            lower_bound = lower_bound or lo
            upper_bound = upper_bound or hi
        if lower_bound is not None and upper_bound is not None and lower_bound != upper_bound:
            return spark.read.jdbc(
                url,
                table,
                column="window_start",
                lowerBound=lower_bound,
                upperBound=upper_bound,
                numPartitions=num_partitions,
                properties=properties,
            )
    return spark.read.jdbc(url, table, properties=properties)
