"""Every registered query has an oracle and matches it on sf0.001
(the full sf0.01 comparison is ``python tools/compare.py``)."""

from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from .conftest import SF001  # noqa: E402


def test_every_query_has_oracle_sql():
    from __spark_entry__ import oracle_sql, queries
    from eventide.plans import QUERIES
    from eventide.plans import oracle_sql as own_sql

    assert set(QUERIES) == set(own_sql())
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_queries_give_the_callers_time_zone_back(spark):
    from eventide.plans import QUERIES

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = QUERIES["report_latest"](spark, SF001).collect()
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows == QUERIES["report_latest"](spark, SF001).collect()


def test_streams_read_a_folder_like_a_file(spark, tmp_path):
    """Three part files give the rows that one file gives, in every streaming query."""
    from eventide.plans import QUERIES

    folder = str(tmp_path / "sf")
    spark.read.parquet(f"{SF001}/events.parquet").repartition(3).write.parquet(f"{folder}/events.parquet")
    for name in ("streaming_tumble_1m", "upsert_replay", "summary_rejects", "upsert_resubmit"):
        one = sorted(map(repr, QUERIES[name](spark, SF001).collect()))
        assert one and sorted(map(repr, QUERIES[name](spark, folder).collect())) == one, name


def test_runs_leave_no_folder_behind(spark):
    import os

    from eventide.plans import QUERIES
    from eventide.session import shared_dir

    QUERIES["summary_rejects"](spark, SF001)
    assert os.listdir(f"{shared_dir(spark)}/eventide/summary_rejects") == []


def test_period_reaches_the_scan_of_all_report_queries(spark):
    from eventide.plans import QUERIES
    from eventide.plans.inspect import physical_plan

    for name in QUERIES:
        if name.startswith("report_") and name != "report_latest":
            pushed = [line for line in physical_plan(QUERIES[name](spark, SF001)).splitlines() if "PushedFilters" in line]
            assert pushed and all("GreaterThanOrEqual(ts" in line and "LessThan(ts" in line for line in pushed), name


def test_sample_is_picked_before_it_is_encoded(spark):
    from eventide.plans import QUERIES
    from eventide.plans.inspect import physical_plan

    top, below = physical_plan(QUERIES["sample_events"](spark, SF001)).split("TakeOrderedAndProject")[1].split("\n", 1)
    value = re.search(r"value#\d+", top)[0]
    assert value not in below and "structstojson" not in below.lower() and "AS value" not in below


def test_one_hour_and_a_day_differ(spark):
    from eventide.plans import QUERIES

    sf = "/root/testdata/sf0.01"
    assert QUERIES["report_last_period"](spark, sf).count() == 11
    assert QUERIES["report_last_period_24h"](spark, sf).count() == 100
    assert QUERIES["report_formatted_whole_period"](spark, sf).where("section = 2").count() == 305


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "category", "event_count", "purchase_count", "total_revenue"]
    assert df.count() > 0


@pytest.mark.parametrize(
    "name",
    [
        "tumble_1m", "tumble_7m", "tumble_1h", "tumble_null_amounts", "parse_events", "parse_events_dirty",
        "parse_rejects", "parse_quality", "report_latest", "revenue_by_category", "events_per_window",
        "report_last_period", "report_last_period_24h", "report_totals", "report_totals_whole_period", "report_with_total",
        "report_totals_empty", "report_formatted", "report_formatted_whole_period", "report_formatted_empty", "summary_freshness",
        "streaming_tumble_1m", "streaming_late_rows", "upsert_replay", "upsert_resubmit", "summary_rejects", "sample_events", "encode_roundtrip",
    ],
)
def test_query_matches_oracle(spark, name):
    from compare import compare

    res = compare(spark, SF001, [name], verbose=False)[name]
    assert res[0] == "OK", res


@pytest.mark.parametrize("name", ["tumble_1m", "parse_quality", "report_totals", "report_formatted", "sample_events"])
def test_registered_plans_stay_in_the_jvm(spark, name):
    from __spark_entry__ import queries

    from eventide.plans.inspect import uses_python

    assert not uses_python(queries()[name](spark, SF001))


def test_flagship_scan_reads_only_needed_columns(spark):
    from __spark_entry__ import queries

    from eventide.plans.inspect import physical_plan

    plan = physical_plan(queries()["tumble_1m"](spark, SF001))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "event_id" not in scan.split("ReadSchema")[1]
    assert plan.count("from_json") == 1
