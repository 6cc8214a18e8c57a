"""Reports over the summary table (the hourly report and the ad-hoc queries).

All of them are plans over the summary DataFrame: top-k sorts compile to
TakeOrderedAndProject (each task keeps k rows, the driver merges k x tasks),
re-aggregations to partial + final HashAggregate. Totals are one aggregate of
the *limited* rows, so nothing is looped over on the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ADHOC_LIMIT, DOUBLE_RULE, NO_DATA, REPORT_LIMIT, REPORT_PERIOD, REPORT_TITLE, SINGLE_RULE
from ..functions.text import fmt_int, fmt_money, pad_left, pad_right, ts19

MONEY = "decimal(18,2)"


def money(c: Column) -> Column:
    """Round to cents (half up) and type as NUMERIC(18,2)."""
    return F.round(c, 2).cast(MONEY)


def _as_of(as_of: dt.datetime | str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def latest(summary: DataFrame, n: int = ADHOC_LIMIT) -> DataFrame:
    """Most recent n summary *rows* (not windows), newest first; ties on
    window_start are broken by category."""
    return (
        summary.select(
            "window_start",
            "window_end",
            "category",
            "event_count",
            "purchase_count",
            money(F.col("total_revenue")).alias("revenue"),
        )
        .orderBy(F.col("window_start").desc(), F.col("category").asc_nulls_first())
        .limit(n)
    )


def revenue_by_category(summary: DataFrame) -> DataFrame:
    """All-time totals per category, highest revenue first (NULL first, as a
    DESC sort does in the summary database)."""
    return (
        summary.groupBy("category")
        .agg(
            F.sum("event_count").alias("total_events"),
            F.sum("purchase_count").alias("total_purchases"),
            money(F.sum("total_revenue")).alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("category").asc_nulls_first())
    )


def events_per_window(summary: DataFrame, n: int = ADHOC_LIMIT) -> DataFrame:
    """Events and purchases per window over all categories, last n windows."""
    return (
        summary.groupBy("window_start")
        .agg(F.sum("event_count").alias("total_events"), F.sum("purchase_count").alias("purchases"))
        .orderBy(F.col("window_start").desc())
        .limit(n)
    )


def report_order() -> list[Column]:
    """Order of the printed report: newest window, highest revenue (NULL
    first), then category."""
    return [F.col("window_start").desc(), F.col("total_revenue").desc_nulls_first(), F.col("category").asc_nulls_first()]


def last_period(
    summary: DataFrame,
    as_of: dt.datetime | str | Column | None = None,
    period: str = REPORT_PERIOD,
    limit: int | None = REPORT_LIMIT,
) -> DataFrame:
    """Closed windows of the period up to ``as_of``: ``window_start >= as_of -
    period`` and ``window_end <= as_of`` (both inclusive), newest window first,
    then highest rounded revenue (NULL first), then category. ``as_of``
    defaults to now; ``limit=None`` keeps the whole period. A ``window_date``
    column, as the file sinks write it, prunes the scan to the period's dates."""
    until = _as_of(as_of)
    since = until - F.expr(f"INTERVAL {period}")
    if "window_date" in summary.columns:
        summary = summary.where(F.col("window_date").between(F.to_date(since), F.to_date(until)))
    rows = (
        summary.where((F.col("window_start") >= since) & (F.col("window_end") <= until))
        .select(
            "window_start",
            "window_end",
            "category",
            "event_count",
            "purchase_count",
            money(F.col("total_revenue")).alias("total_revenue"),
        )
        .orderBy(*report_order())
    )
    return rows.limit(limit) if limit is not None else rows


def totals(report: DataFrame) -> DataFrame:
    """One row: totals of the report rows, conversion rate in percent (1 dp,
    NULL when there are no events) and average order value (revenue over
    purchases, at least 1). An empty report gives zeros and a NULL rate."""
    return report.agg(*_totals())


def _totals() -> list[Column]:
    events = F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint")
    purchases = F.coalesce(F.sum("purchase_count"), F.lit(0)).cast("bigint")
    revenue = F.coalesce(F.sum("total_revenue"), F.lit(0)).cast(MONEY)
    return [
        events.alias("total_events"),
        purchases.alias("total_purchases"),
        revenue.alias("total_revenue"),
        F.round(F.try_divide(purchases * F.lit(100), events), 1).alias("conversion_rate_pct"),
        money(revenue / F.greatest(purchases, F.lit(1))).alias("avg_order_value"),
    ]


def with_total(report: DataFrame) -> DataFrame:
    """Report rows plus one TOTAL row in a single aggregate over the limited
    rows: GROUPING SETS ((window_start, category), ())."""
    grouped = report.groupingSets(
        [[F.col("window_start"), F.col("category")], []], F.col("window_start"), F.col("category")
    ).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("purchase_count").alias("purchase_count"),
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        F.grouping_id().alias("_gid"),
    )
    return grouped.select(
        F.when(F.col("_gid") == 0, F.lit("ROW")).otherwise(F.lit("TOTAL")).alias("row_type"),
        "window_start",
        "category",
        "event_count",
        "purchase_count",
        "total_revenue",
    )


def numbered(report: DataFrame) -> DataFrame:
    """``report`` with ``line_no`` 1, 2, ... in report order. Rows are numbered
    within their date and shifted by the rows of later dates; only one count
    per date meets in one task."""
    dated = report.withColumn("_date", F.to_date("window_start"))
    later = Window.orderBy(F.col("_date").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    counts = dated.groupBy("_date").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select("_date", F.coalesce(F.sum("_rows").over(later), F.lit(0)).alias("_before"))
    inside = dated.withColumn("_inside", F.row_number().over(Window.partitionBy("_date").orderBy(*report_order())))
    a, b = inside.alias("a"), before.alias("b")
    joined = a.join(b, F.col("a._date").eqNullSafe(F.col("b._date")))
    return joined.select(*[F.col(f"a.{c}").alias(c) for c in report.columns], (F.col("_before") + F.col("_inside")).cast("bigint").alias("line_no"))


def formatted(report: DataFrame, title: str = REPORT_TITLE) -> DataFrame:
    """The printed report as (section, line_no, line), in that order: 0 title, 1
    column heads, 2 one line per row of ``report``, 3 totals of exactly these
    rows, 4 rates. An empty report has its title and one line that says so.

    All rows that are passed in are printed; cut them beforehand with the
    ``limit`` of ``last_period``."""
    header = (
        "Window Start".ljust(22) + " " + "Category".ljust(14) + " " + "Events".rjust(8)
        + " " + "Purchases".rjust(10) + " " + "Revenue ($)".rjust(12)
    )
    double, single = F.lit(DOUBLE_RULE), F.lit(SINGLE_RULE)
    rows = numbered(report).select(
        F.lit(2).alias("section"),
        "line_no",
        F.concat_ws(
            " ",
            pad_right(ts19(F.col("window_start")), 22),
            pad_right(F.coalesce(F.col("category"), F.lit("(null)")), 14),
            pad_left(F.coalesce(fmt_int(F.col("event_count")), F.lit("")), 8),
            pad_left(F.coalesce(fmt_int(F.col("purchase_count")), F.lit("")), 10),
            pad_left(F.coalesce(fmt_money(F.col("total_revenue")), F.lit("")), 12),
        ).alias("line"),
    )
    total_line = F.concat_ws(
        " ",
        pad_right(F.lit("TOTAL"), 22),
        pad_right(F.lit(""), 14),
        pad_left(fmt_int(F.col("total_events")), 8),
        pad_left(fmt_int(F.col("total_purchases")), 10),
        pad_left(fmt_money(F.col("total_revenue")), 12),
    )
    percent = F.col("conversion_rate_pct")
    rates_line = F.concat(
        F.lit("  Conversion rate: "),
        F.when(percent.isNotNull(), F.format_string("%.1f%%", percent)).otherwise("n/a"),
        F.lit("  |  Avg order value: $"),
        F.format_string("%.2f", F.col("avg_order_value").cast("double")),
    )

    def lines(*texts: tuple[int, int, Column]) -> Column:
        return F.array(*[F.struct(F.lit(s).alias("section"), F.lit(n).cast("bigint").alias("line_no"), t.alias("line")) for s, n, t in texts])

    # Everything but the rows comes from the one-row totals.
    top = [(0, 1, double), (0, 2, F.lit(title)), (0, 3, double)]
    full = lines(*top, (1, 1, F.lit(header)), (1, 2, single), (3, 1, single), (3, 2, total_line), (3, 3, double), (4, 1, rates_line), (4, 2, double))
    empty = lines(*top, (1, 1, F.lit(NO_DATA)), (1, 2, double))
    frame = report.agg(*_totals(), F.count(F.lit(1)).alias("rows")).select(F.inline(F.when(F.col("rows") > 0, full).otherwise(empty)))
    return frame.unionByName(rows)
