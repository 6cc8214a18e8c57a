"""DuckDB SQL for every registered query, over the raw ``events`` view.

The SQL restates each query's intended semantics independently of the Spark
code: it maps ``events`` to wire fields directly (no JSON), applies the dirty
rules of ``fixtures`` by ``event_id mod 11`` as plain CASE expressions, and
buckets windows by epoch-microsecond arithmetic.
"""

from __future__ import annotations

from .registry import EMPTY_AS_OF, FRESHNESS_AS_OF, REPORT_AS_OF

# Written out here and not imported, so that a wrong value shows.
CATEGORIES = ("electronics", "clothing", "books", "sports", "home", "beauty", "toys")
PRODUCTS = (
    ("laptop", "smartphone", "headphones", "tablet", "smartwatch"), ("jacket", "jeans", "sneakers", "dress", "hoodie"),
    ("novel", "textbook", "cookbook", "biography", "comic"), ("yoga_mat", "dumbbells", "bike_helmet", "running_shoes", "water_bottle"),
    ("lamp", "pillow", "coffee_maker", "candle", "plant_pot"), ("moisturizer", "lipstick", "perfume", "shampoo", "serum"),
    ("lego_set", "board_game", "action_figure", "puzzle", "rc_car"),
)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


CATS = _list(CATEGORIES)
PRODS = "[" + ", ".join(_list(p) for p in PRODUCTS) + "]"

WIRE = f"""wire AS (
  SELECT e.event_id,
         CAST(e.event_id % 3 AS INTEGER) AS "partition",
         e.event_id // 3 AS "offset",
         printf('user_%04d', e.user_id) AS user_id,
         printf('sess_%04d', e.user_id % 100 + 1) AS session_id,
         printf('%s_%s_%03d', {CATS}[e.k % 7 + 1], {PRODS}[e.k % 7 + 1][(e.k // 7) % 5 + 1], e.k % 50 + 1) AS product_id,
         {CATS}[e.k % 7 + 1] AS category,
         e.event_type,
         CASE WHEN e.event_type = 'purchase' THEN e.value ELSE 0.0 END AS amount,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS "timestamp",
         e.ts AS event_time
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

DIRTY = """dirty AS (
  SELECT *, CAST(event_id % 11 AS INTEGER) AS m FROM wire
),
dirty_valid AS (
  SELECT "partition", "offset",
         CASE WHEN m = 10 THEN '{"a":1}' ELSE user_id END AS user_id,
         session_id, product_id,
         CASE WHEN m = 3 THEN NULL ELSE category END AS category,
         event_type,
         CASE WHEN m IN (2, 9) THEN NULL ELSE amount END AS amount,
         CASE WHEN m = 4 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S+00:00') ELSE "timestamp" END AS "timestamp",
         CASE WHEN m = 4 THEN NULL ELSE event_time END AS event_time
  FROM dirty WHERE m NOT IN (1, 5, 6, 8)
)"""

EVENT_COLS = '"partition", "offset", user_id, session_id, product_id, category, event_type, amount, "timestamp", event_time'


def tumble(src: str, minutes: int) -> str:
    u = minutes * 60_000_000
    return f"""SELECT make_timestamp((epoch_us(event_time) // {u}) * {u}) AS window_start,
         make_timestamp((epoch_us(event_time) // {u}) * {u} + {u}) AS window_end,
         category,
         COUNT(*) AS event_count,
         COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchase_count,
         COALESCE(SUM(amount), 0.0) AS total_revenue
  FROM {src} WHERE event_time IS NOT NULL GROUP BY ALL"""


SUMMARY = f"summary AS (\n  {tumble('wire', 1)}\n)"

ROUNDED = "window_start, window_end, category, event_count, purchase_count, ROUND(total_revenue, 2) AS total_revenue"


def _period(hours: int, as_of: str = REPORT_AS_OF, limit: int | None = 100) -> str:
    limit_sql = f"\n  LIMIT {limit}" if limit is not None else ""
    return f"""period AS (
  SELECT window_start, window_end, category, event_count, purchase_count,
         CAST(ROUND(total_revenue, 2) AS DECIMAL(18,2)) AS total_revenue
  FROM summary
  WHERE window_start >= TIMESTAMP '{as_of}' - INTERVAL {hours} HOUR AND window_end <= TIMESTAMP '{as_of}'
  ORDER BY window_start DESC, total_revenue DESC NULLS FIRST, category ASC NULLS FIRST{limit_sql}
)"""


TOTALS = """SELECT CAST(COALESCE(SUM(event_count), 0) AS BIGINT) AS total_events,
       CAST(COALESCE(SUM(purchase_count), 0) AS BIGINT) AS total_purchases,
       CAST(COALESCE(SUM(total_revenue), 0) AS DECIMAL(18,2)) AS total_revenue,
       CASE WHEN COALESCE(SUM(event_count), 0) = 0 THEN NULL
            ELSE ROUND(CAST(SUM(purchase_count) * 100 AS DOUBLE) / SUM(event_count), 1) END AS conversion_rate_pct,
       CAST(ROUND(CAST(COALESCE(SUM(total_revenue), 0) AS DOUBLE) / GREATEST(COALESCE(SUM(purchase_count), 0), 1), 2) AS DECIMAL(18,2)) AS avg_order_value
FROM period"""


def _closed(src: str) -> str:
    return f"""closed AS (
  SELECT * FROM ({tumble(src, 1)}) t
  WHERE window_end <= (SELECT MAX(event_time) FROM {src}) - INTERVAL 10 SECOND
)"""


def _printed(title: str) -> str:
    """The printed report over ``period``, line by line."""
    return f"""tot AS ({TOTALS}),
size AS (SELECT COUNT(*) AS n FROM period)
SELECT section, CAST(line_no AS BIGINT) AS line_no, line FROM (
  SELECT 0 AS section, 1 AS line_no, repeat('=', 75) AS line
  UNION ALL SELECT 0, 2, '  CLICKSTREAM ANALYTICS REPORT — {title}'
  UNION ALL SELECT 0, 3, repeat('=', 75)
  UNION ALL SELECT 1, 1, 'Window Start           Category         Events  Purchases  Revenue ($)' FROM size WHERE n > 0
  UNION ALL SELECT 1, 1, '  No data yet. The streaming job may still be warming up.' FROM size WHERE n = 0
  UNION ALL SELECT 1, 2, repeat(CASE WHEN n > 0 THEN '-' ELSE '=' END, 75) FROM size
  UNION ALL SELECT 2, ROW_NUMBER() OVER (ORDER BY window_start DESC, total_revenue DESC NULLS FIRST, category ASC NULLS FIRST),
       format('{{:<22}}', strftime(window_start, '%Y-%m-%d %H:%M:%S')) || ' ' ||
       format('{{:<14}}', COALESCE(category, '(null)')) || ' ' ||
       format('{{:>8}}', format('{{:,}}', event_count)) || ' ' ||
       format('{{:>10}}', format('{{:,}}', purchase_count)) || ' ' ||
       format('{{:>12}}', COALESCE(format('{{:,.2f}}', total_revenue), '')) FROM period
  UNION ALL SELECT 3, 1, repeat('-', 75) FROM size WHERE n > 0
  UNION ALL SELECT 3, 2, format('{{:<22}}', 'TOTAL') || ' ' || format('{{:<14}}', '') || ' ' ||
       format('{{:>8}}', format('{{:,}}', total_events)) || ' ' ||
       format('{{:>10}}', format('{{:,}}', total_purchases)) || ' ' ||
       format('{{:>12}}', format('{{:,.2f}}', total_revenue)) FROM tot, size WHERE n > 0
  UNION ALL SELECT 3, 3, repeat('=', 75) FROM size WHERE n > 0
  UNION ALL SELECT 4, 1, '  Conversion rate: ' || COALESCE(printf('%.1f%%', conversion_rate_pct), 'n/a') ||
       '  |  Avg order value: $' || printf('%.2f', avg_order_value) FROM tot, size WHERE n > 0
  UNION ALL SELECT 4, 2, repeat('=', 75) FROM size WHERE n > 0
) lines"""


def oracle_sql() -> dict[str, str]:
    w = f"WITH {WIRE}"
    ws = f"WITH {WIRE},\n{SUMMARY}"
    q = {
        "tumble_1m": f"{w}\nSELECT {ROUNDED} FROM ({tumble('wire', 1)}) t",
        "tumble_7m": f"{w}\nSELECT {ROUNDED} FROM ({tumble('wire', 7)}) t",
        "tumble_1h": f"{w}\nSELECT {ROUNDED} FROM ({tumble('wire', 60)}) t",
        "tumble_null_amounts": f"""{w},
nulled AS (
  SELECT event_time, category, event_type,
         CASE WHEN event_id % 5 = 0 OR category = 'books' THEN NULL ELSE amount END AS amount
  FROM wire
)
SELECT {ROUNDED} FROM ({tumble('nulled', 1)}) t""",
        "parse_events": f"{w}\nSELECT {EVENT_COLS} FROM wire",
        "parse_events_dirty": f"{w},\n{DIRTY}\nSELECT {EVENT_COLS} FROM dirty_valid",
        "parse_rejects": f"""{w},\n{DIRTY}
SELECT "partition", "offset",
       CASE m WHEN 1 THEN '{{bad json ' || CAST(event_id AS VARCHAR) WHEN 5 THEN '' WHEN 6 THEN '[]' ELSE 'null' END AS value,
       CASE WHEN m = 5 THEN 'empty' ELSE 'corrupt' END AS reason
FROM dirty WHERE m IN (1, 5, 6, 8)""",
        "parse_quality": f"""{w},\n{DIRTY}
SELECT COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE m NOT IN (1, 5, 6, 8)) AS accepted_records,
       COUNT(*) FILTER (WHERE m IN (1, 6, 8)) AS corrupt_records,
       COUNT(*) FILTER (WHERE m = 5) AS empty_records,
       COUNT(*) FILTER (WHERE m = 4) AS null_event_time,
       COUNT(*) FILTER (WHERE m = 3) AS null_category,
       COUNT(*) FILTER (WHERE m IN (2, 9)) AS bad_amount
FROM dirty""",
        "report_latest": f"""{ws}
SELECT window_start, window_end, category, event_count, purchase_count,
       CAST(ROUND(total_revenue, 2) AS DECIMAL(18,2)) AS revenue
FROM summary ORDER BY window_start DESC, category ASC NULLS FIRST LIMIT 10""",
        "revenue_by_category": f"""{ws}
SELECT category, CAST(SUM(event_count) AS BIGINT) AS total_events,
       CAST(SUM(purchase_count) AS BIGINT) AS total_purchases,
       CAST(ROUND(SUM(total_revenue), 2) AS DECIMAL(18,2)) AS total_revenue
FROM summary GROUP BY category ORDER BY total_revenue DESC NULLS FIRST, category""",
        "events_per_window": f"""{ws}
SELECT window_start, CAST(SUM(event_count) AS BIGINT) AS total_events,
       CAST(SUM(purchase_count) AS BIGINT) AS purchases
FROM summary GROUP BY window_start ORDER BY window_start DESC LIMIT 10""",
        "report_last_period": f"{ws},\n{_period(1)}\nSELECT * FROM period",
        "report_last_period_24h": f"{ws},\n{_period(24)}\nSELECT * FROM period",
        "report_totals": f"{ws},\n{_period(24)}\n{TOTALS}",
        "report_totals_whole_period": f"{ws},\n{_period(24, limit=None)}\n{TOTALS}",
        "report_with_total": f"""{ws},\n{_period(24)}
SELECT CASE WHEN GROUPING(window_start, category) = 0 THEN 'ROW' ELSE 'TOTAL' END AS row_type,
       window_start, category,
       CAST(SUM(event_count) AS BIGINT) AS event_count,
       CAST(SUM(purchase_count) AS BIGINT) AS purchase_count,
       CAST(SUM(total_revenue) AS DECIMAL(18,2)) AS total_revenue
FROM period GROUP BY GROUPING SETS ((window_start, category), ())""",
        "report_totals_empty": f"{ws},\n{_period(1, EMPTY_AS_OF)}\n{TOTALS}",
        "report_formatted": f"{ws},\n{_period(24)},\n{_printed('Last 24 Hours')}",
        "report_formatted_whole_period": f"{ws},\n{_period(24, limit=None)},\n{_printed('Last 24 Hours')}",
        "report_formatted_empty": f"{ws},\n{_period(1, EMPTY_AS_OF)},\n{_printed('Last 60 Minutes')}",
        "summary_freshness": f"""{ws}
SELECT MAX(window_end) AS last_window_end,
       COUNT(*) AS summary_rows,
       ROUND(epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(MAX(window_end)), 3) AS lag_seconds,
       COALESCE(MAX(window_end) < TIMESTAMP '{FRESHNESS_AS_OF}' - INTERVAL 5 MINUTE, TRUE) AS is_stale
FROM summary""",
        "streaming_tumble_1m": f"{w},\n{_closed('wire')}\nSELECT {ROUNDED} FROM closed",
        "streaming_late_rows": f"""{w},
ends AS (
  SELECT MIN(epoch_us(event_time)) AS lo, MAX(epoch_us(event_time)) AS hi,
         MAX(event_time) - INTERVAL 10 SECOND AS last_mark
  FROM wire
),
marks AS (
  SELECT last_mark, (
    -- A batch drops rows by the watermark that the batch before it began with: here that of the first two slices.
    SELECT MAX(event_time) FROM wire WHERE event_id % 10 <> 3 AND epoch_us(event_time) < lo + (hi - lo) * 2 // 3
  ) - INTERVAL 10 SECOND AS mark
  FROM ends
),
seen AS (
  SELECT wire.* FROM wire, marks
  WHERE event_id % 10 <> 3
     OR make_timestamp((epoch_us(event_time) // 60000000 + 1) * 60000000) > mark
)
SELECT {ROUNDED} FROM ({tumble('seen', 1)}) t, marks WHERE window_end <= last_mark""",
        "upsert_resubmit": f"""{w},
first_events AS (SELECT * FROM wire WHERE event_id % 3 <> 0 AND category <> 'books'),
second_events AS (SELECT * FROM wire WHERE event_id % 2 = 0),
first_run AS (
  SELECT * FROM ({tumble('first_events', 1)}) t
  WHERE window_end <= (SELECT MAX(event_time) FROM first_events) - INTERVAL 10 SECOND
),
second_run AS (
  SELECT * FROM ({tumble('second_events', 1)}) t
  WHERE window_end <= (SELECT MAX(event_time) FROM second_events) - INTERVAL 10 SECOND
)
SELECT {ROUNDED} FROM (
  SELECT * FROM second_run
  UNION ALL
  SELECT * FROM first_run f WHERE NOT EXISTS (
    SELECT 1 FROM second_run s WHERE s.window_start = f.window_start AND s.category = f.category)
) u""",
        "upsert_replay": f"{w},\n{_closed('wire')}\nSELECT {ROUNDED} FROM closed",
        "summary_rejects": f"{w},\n{DIRTY},\n{_closed('dirty_valid')}\nSELECT {ROUNDED} FROM closed WHERE category IS NULL",
        "streaming_split_watermark": f"""{w},
arrived AS (
  SELECT wire.* FROM wire, (SELECT MAX(event_time) AS hi FROM wire) ends
  WHERE "partition" <> 2 OR event_time <= hi - INTERVAL 30 MINUTE
),
mark AS (SELECT MIN(hi) - INTERVAL 10 SECOND AS mark FROM (SELECT MAX(event_time) AS hi FROM arrived GROUP BY "partition") p)
SELECT {ROUNDED} FROM ({tumble('arrived', 1)}) t, mark WHERE window_end <= mark""",
        "open_windows": f"""{w}
SELECT {ROUNDED} FROM ({tumble('wire', 1)}) t
WHERE window_end > (SELECT MAX(event_time) FROM wire) - INTERVAL 10 SECOND""",
        "streaming_progress": f"""{w}
SELECT COUNT(*) AS input_rows, CAST(0 AS BIGINT) AS dropped_by_watermark,
       (SELECT COUNT(*) FROM ({tumble('wire', 1)}) t WHERE window_end > (SELECT MAX(event_time) FROM wire) - INTERVAL 10 SECOND) AS state_rows,
       date_trunc('milliseconds', MAX(event_time) - INTERVAL 10 SECOND) AS watermark
FROM wire""",
        "streaming_restart": f"{w},\n{_closed('wire')}\nSELECT {ROUNDED} FROM closed",
        "streaming_rejects": f"""{w},\n{DIRTY}
SELECT "partition", "offset",
       CASE m WHEN 1 THEN '{{bad json ' || CAST(event_id AS VARCHAR) WHEN 5 THEN '' WHEN 6 THEN '[]' ELSE 'null' END AS value,
       CASE WHEN m = 5 THEN 'empty' ELSE 'corrupt' END AS reason
FROM dirty WHERE m IN (1, 5, 6, 8)""",
        "upsert_duplicate_keys": f"""{w},\n{_closed('wire')}
SELECT {ROUNDED}, CASE WHEN category = 'books' THEN 'duplicate key' END AS reason FROM (
  SELECT * FROM closed
  UNION ALL
  SELECT window_start, window_end, category, event_count + 1, purchase_count, total_revenue FROM closed WHERE category = 'books'
) u""",
        "latest_from_table": f"""{ws}
SELECT window_start, window_end, category, event_count, purchase_count,
       CAST(ROUND(total_revenue, 2) AS DECIMAL(18,2)) AS revenue
FROM summary ORDER BY window_start DESC, category ASC NULLS FIRST LIMIT 10""",
        "revenue_rollup": f"""{ws}
SELECT category, CAST(SUM(event_count) AS BIGINT) AS total_events,
       CAST(SUM(purchase_count) AS BIGINT) AS total_purchases,
       CAST(ROUND(SUM(total_revenue), 2) AS DECIMAL(18,2)) AS total_revenue
FROM summary GROUP BY category""",
        "sample_events": f"""{w}
SELECT "partition", "offset",
       CAST(to_json(struct_pack(user_id := user_id, session_id := session_id, product_id := product_id,
                                category := category, event_type := event_type, amount := amount,
                                "timestamp" := "timestamp")) AS VARCHAR) AS value
FROM wire ORDER BY "partition", "offset" LIMIT 5""",
        "encode_roundtrip": f"""{w}
SELECT event_id, user_id, session_id, product_id, category, event_type, amount, "timestamp", event_time FROM wire""",
    }
    return q
