"""Reports over a hand-made summary."""

from __future__ import annotations

from eventide.plans.inspect import physical_plan

import datetime as dt
from decimal import Decimal

from eventide.operators import events_per_window, formatted, last_period, latest, revenue_by_category, totals, with_total

T0 = dt.datetime(2024, 1, 1, 12)
SCHEMA = "window_start timestamp, window_end timestamp, category string, event_count long, purchase_count long, total_revenue double"


def _summary(spark):
    m = dt.timedelta(minutes=1)
    rows = [
        (T0, T0 + m, "books", 10, 2, 20.005),
        (T0, T0 + m, "toys", 5, 1, 2.675),
        (T0 + m, T0 + 2 * m, "books", 3, 0, 0.0),
        (T0 + m, T0 + 2 * m, "home", 4, 1, None),
        (T0 - dt.timedelta(hours=2), T0 - dt.timedelta(hours=2) + m, "toys", 7, 7, 70.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_latest_orders_rows_and_rounds(spark):
    out = latest(_summary(spark), 3).collect()
    assert [(r["window_start"], r["category"]) for r in out] == [(T0 + dt.timedelta(minutes=1), "books"), (T0 + dt.timedelta(minutes=1), "home"), (T0, "books")]
    assert out[2]["revenue"] == Decimal("20.01")


def test_revenue_by_category_nulls_first(spark):
    out = revenue_by_category(_summary(spark)).collect()
    # home's only revenue is NULL: its sum is NULL and sorts first on DESC
    assert [r["category"] for r in out] == ["home", "toys", "books"]
    assert out[0]["total_revenue"] is None and out[1]["total_revenue"] == Decimal("72.68")


def test_events_per_window(spark):
    out = events_per_window(_summary(spark), 2).collect()
    assert [(r["total_events"], r["purchases"]) for r in out] == [(7, 1), (15, 3)]


def test_last_period_totals_and_total_row(spark):
    rep = last_period(_summary(spark), as_of=T0 + dt.timedelta(minutes=30), period="1 hour")
    rows = rep.collect()
    assert [r["category"] for r in rows] == ["home", "books", "books", "toys"]  # NULL revenue first
    t = totals(rep).first()
    assert (t["total_events"], t["total_purchases"]) == (22, 4)
    assert t["total_revenue"] == Decimal("22.69")
    assert t["conversion_rate_pct"] == 18.2
    assert t["avg_order_value"] == Decimal("5.67")
    wt = with_total(rep).collect()
    assert len(wt) == 5 and sum(r["row_type"] == "TOTAL" for r in wt) == 1


def test_limit_applies_before_totals(spark):
    rep = last_period(_summary(spark), as_of=T0 + dt.timedelta(minutes=30), period="1 hour", limit=1)
    assert totals(rep).first()["total_events"] == 4


def test_empty_report(spark):
    rep = last_period(_summary(spark), as_of=dt.datetime(2030, 1, 1), period="1 hour")
    t = totals(rep).first()
    assert (t["total_events"], t["total_purchases"], t["conversion_rate_pct"]) == (0, 0, None)
    assert t["avg_order_value"] == Decimal("0.00")


def _lines(report):
    return [r["line"] for r in formatted(report).orderBy("section", "line_no").collect()]


def test_formatted_lines(spark):
    rep = last_period(_summary(spark), as_of=T0 + dt.timedelta(minutes=30), period="1 hour")
    lines = _lines(rep)
    assert lines[0] == lines[2] == "=" * 75 and lines[1].startswith("  CLICKSTREAM ANALYTICS REPORT")
    assert lines[3].startswith("Window Start") and lines[4] == "-" * 75
    assert lines[5] == f"{'2024-01-01 12:01:00':<22} {'home':<14} {4:>8,} {1:>10,} {'':>12}"
    assert lines[6] == f"{'2024-01-01 12:01:00':<22} {'books':<14} {3:>8,} {0:>10,} {0.0:>12,.2f}"
    assert lines[-5] == "-" * 75 and lines[-4].startswith("TOTAL") and lines[-3] == "=" * 75
    assert lines[-2:] == ["  Conversion rate: 18.2%  |  Avg order value: $5.67", "=" * 75]


def test_empty_report_says_so(spark):
    rep = last_period(_summary(spark), as_of=dt.datetime(2030, 1, 1), period="1 hour")
    lines = _lines(rep)
    assert len(lines) == 5 and lines[3].startswith("  No data yet.")


def test_no_events_give_no_rate(spark):
    summary = spark.createDataFrame([(T0, T0 + dt.timedelta(minutes=1), "a", 0, 0, 0.0)], SCHEMA)
    lines = _lines(last_period(summary, as_of=T0 + dt.timedelta(minutes=5)))
    assert lines[-2] == "  Conversion rate: n/a  |  Avg order value: $0.00"


def test_windows_after_as_of_are_not_reported(spark):
    rep = last_period(_summary(spark), as_of=T0 + dt.timedelta(seconds=90), period="1 hour")
    assert [r["category"] for r in rep.collect()] == ["books", "toys"]  # the 12:01 window is still open


def test_formatted_prints_all_rows_over_several_dates(spark):
    day, minute = dt.timedelta(days=1), dt.timedelta(minutes=1)
    rows = [(T0 - i * 7 * minute, T0 - i * 7 * minute + minute, f"c{i % 3}", i, 1, float(i % 5)) for i in range(500)]
    summary = spark.createDataFrame(rows, SCHEMA)
    rep = last_period(summary, as_of=T0 + day, period="30 days", limit=None)
    out = formatted(rep)
    body = [r["line"] for r in out.where("section = 2").orderBy("line_no").collect()]
    expected = sorted(rows, key=lambda r: (-r[0].timestamp(), -r[5], r[2]))
    assert [line[:19] for line in body] == [str(r[0]) for r in expected]
    total = out.where("section = 3 and line_no = 2").first()["line"]
    assert total.split()[1] == f"{totals(rep).first()['total_events']:,}" == f"{sum(r[3] for r in rows):,}"


def test_window_dates_prune_the_scan(spark, workdir):
    from pyspark.sql import functions as F

    _summary(spark).withColumn("window_date", F.to_date("window_start")).write.partitionBy("window_date").parquet(f"{workdir}/d")
    plan = physical_plan(last_period(spark.read.parquet(f"{workdir}/d"), as_of=T0, period="1 hour"))
    assert "PartitionFilters: [isnotnull(window_date" in plan


def test_period_filter_is_pushed_to_parquet(spark, workdir):
    _summary(spark).write.parquet(f"{workdir}/s")
    rep = last_period(spark.read.parquet(f"{workdir}/s"), as_of=T0, period="1 hour")
    plan = physical_plan(rep)
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThanOrEqual(window_start" in pushed and "IsNotNull(window_end)" in pushed  # the text is cut after these


def test_cli_report_prints_and_writes(spark, workdir, capsys):
    from eventide.cli import main

    _summary(spark).write.parquet(f"{workdir}/s")
    main(["report", "--table", f"{workdir}/s", "--as-of", "2024-01-01 12:30:00", "--limit", "2"])
    lines = capsys.readouterr().out.strip().splitlines()
    assert lines[3].startswith("Window Start") and lines[-4].startswith("TOTAL") and len(lines) == 12
    main(["report", "--table", f"{workdir}/s", "--as-of", "2024-01-01 12:30:00", "--limit", "0"])
    assert len(capsys.readouterr().out.strip().splitlines()) == 14
    main(["report", "--table", f"{workdir}/s", "--as-of", "2024-01-01 12:30:00", "--out", f"{workdir}/r"])
    assert spark.read.parquet(f"{workdir}/r/rows").count() == 4
    assert spark.read.parquet(f"{workdir}/r/totals").first()["total_events"] == 22


def test_cli_adhoc_queries(spark, workdir, capsys):
    from eventide.cli import main

    _summary(spark).write.parquet(f"{workdir}/s")
    main(["query", "--table", f"{workdir}/s"])
    out = capsys.readouterr().out
    assert "Latest 10 rows" in out and "Revenue by category" in out and "Events per window" in out
    main(["query", "revenue", "--table", f"{workdir}/s"])
    out = capsys.readouterr().out
    assert "Revenue by category" in out and "Latest 10 rows" not in out and "72.68" in out
