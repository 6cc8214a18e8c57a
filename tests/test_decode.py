"""Tolerant decode: the dirty-record and timestamp tables of FIXTURES.md."""

from __future__ import annotations

from eventide.plans.inspect import physical_plan

import datetime as dt

from pyspark.sql import functions as F

from eventide.functions.decode import decode_records, parse_event_time, rejects, valid_events
from eventide.operators import decode_quality

FULL = (
    '{"user_id":"user_0001","session_id":"sess_0001","product_id":"books_novel_001",'
    '"category":"books","event_type":"purchase","amount":12.5,'
    '"timestamp":"2024-01-01T00:00:01.123456+00:00"}'
)

CASES = [
    (0, FULL, "kept"),
    (1, '{"user_id":"u","category":"books","amount":"2.5"}', "kept"),
    (2, '{"user_id":"u","category":7,"amount":"x"}', "kept"),
    (3, '{"user_id":{"a":1},"amount":true}', "kept"),
    (4, '{"a":1}', "kept"),
    (5, "{bad json", "corrupt"),
    (6, "[]", "corrupt"),
    (7, "null", "corrupt"),
    (8, "5", "corrupt"),
    (9, '[{"user_id":"q"},{"user_id":"r"}]', "corrupt"),
    (10, "", "empty"),
]


def _records(spark):
    return spark.createDataFrame([(0, i, v) for i, v, _ in CASES], "partition int, offset long, value string")


def test_accepts_and_rejects(spark):
    decoded = decode_records(_records(spark))
    got = {r["offset"]: r["_reject"] for r in decoded.select("offset", "_reject").collect()}
    for i, _, expect in CASES:
        assert got[i] == (None if expect == "kept" else expect), (i, got[i])


def test_field_level_errors_become_null(spark):
    rows = {r["offset"]: r for r in valid_events(decode_records(_records(spark)), keep=("offset",)).collect()}
    assert rows[0]["amount"] == 12.5 and rows[0]["category"] == "books"
    assert rows[0]["event_time"] == dt.datetime(2024, 1, 1, 0, 0, 1, 123456)
    assert rows[1]["amount"] == 2.5 and rows[1]["session_id"] is None
    assert rows[2]["category"] == "7" and rows[2]["amount"] is None
    assert rows[3]["user_id"] == '{"a":1}' and rows[3]["amount"] is None
    assert all(rows[4][c] is None for c in ("user_id", "category", "amount", "event_time"))
    assert sorted(rows) == [0, 1, 2, 3, 4]


def test_rejects_keep_raw_text(spark):
    out = {r["offset"]: (r["value"], r["reason"]) for r in rejects(decode_records(_records(spark))).collect()}
    assert out[5] == ("{bad json", "corrupt")
    assert out[10] == ("", "empty")
    assert set(out) == {5, 6, 7, 8, 9, 10}


def test_quality_counts(spark):
    q = decode_quality(decode_records(_records(spark))).first().asDict()
    assert q["total_records"] == 11
    assert q["accepted_records"] == 5
    assert q["corrupt_records"] == 5
    assert q["empty_records"] == 1
    assert q["null_event_time"] == 4  # every kept row but the complete one
    assert q["null_category"] == 2
    assert q["bad_amount"] == 2  # "x" and true


TIMES = [
    ("2024-01-01T00:00:01.123456+00:00", dt.datetime(2024, 1, 1, 0, 0, 1, 123456), dt.datetime(2024, 1, 1, 0, 0, 1, 123456)),
    ("2024-01-01T00:00:01.123456Z", dt.datetime(2024, 1, 1, 0, 0, 1, 123456), dt.datetime(2024, 1, 1, 0, 0, 1, 123456)),
    ("2024-01-01T00:00:01.123456+02:00", dt.datetime(2023, 12, 31, 22, 0, 1, 123456), dt.datetime(2023, 12, 31, 22, 0, 1, 123456)),
    ("2024-01-01T00:00:01.123+00:00", None, dt.datetime(2024, 1, 1, 0, 0, 1, 123000)),
    ("2024-01-01T00:00:01+00:00", None, dt.datetime(2024, 1, 1, 0, 0, 1)),
    ("2024-13-01T00:00:01.123456+00:00", None, None),
    ("junk", None, None),
    (None, None, None),
]


def test_event_time_strict_and_lenient(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in TIMES], "t string")
    out = df.select(
        parse_event_time(F.col("t"), strict=True).alias("s"), parse_event_time(F.col("t"), strict=False).alias("l")
    ).collect()
    for (text, strict, lenient), row in zip(TIMES, out):
        assert row["s"] == strict, text
        assert row["l"] == lenient, text


def test_one_from_json_in_plan(spark):
    """The Generate barrier keeps the parse to one evaluation."""
    from eventide.operators import tumbling_summary

    plan = physical_plan(tumbling_summary(valid_events(decode_records(_records(spark)))))
    assert plan.count("from_json") == 1


def test_positional_strict_rule_equals_the_regex(spark):
    """The cheap positional check accepts exactly what regex + parse accept."""
    import itertools

    from eventide.functions.decode import event_time_sql

    fractions = ["", "."] + ["." + "123456789"[:k] for k in range(1, 10)] + [".12345x", ".1234567"]
    offsets = ["Z", "z", "+00:00", "-05:30", "+0000", "+00", "+00:00:00", "", " Z", "+2:00"]
    dates = ["2024-01-01T00:00:01", "2024-1-01T00:00:01", "12024-01-01T00:00:01", "2024-01-01 00:00:01", "2024-02-30T00:00:01"]
    texts = ["".join(p) for p in itertools.product(dates, fractions, offsets)] + ["junk", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(
        "t",
        _by_regex(F.col("t")).alias("regex"),
        parse_event_time(F.col("t")).alias("positional"),
        F.expr(event_time_sql("t")).alias("sql"),
    ).collect()
    accepted = 0
    for r in out:
        assert r["regex"] == r["positional"] == r["sql"], r["t"]
        accepted += r["regex"] is not None
    assert accepted == 3  # six digits with Z, +00:00 and -05:30


def _by_regex(text):
    """The strict rule as a regular expression: six fraction digits and an offset."""
    from eventide.constants import EVENT_TIME_PATTERN

    return F.when(text.rlike(r"\.\d{6}(Z|[+-]\d{2}:\d{2})$"), F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERN)))
