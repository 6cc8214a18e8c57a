"""Property: any typed wire record survives encode -> tolerant decode."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.functions.decode import decode_records, valid_events
from eventide.functions.encode import encode_records

text = st.one_of(st.none(), st.text(min_size=0, max_size=12))
amount = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64))
micros = st.integers(min_value=0, max_value=10**15)  # 1970 .. 2001-09
record = st.tuples(text, text, text, text, text, amount, micros)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(record, min_size=1, max_size=20))
def test_encode_decode_round_trip(spark, rows):
    epoch = dt.datetime(1970, 1, 1)
    data = []
    for i, (u, s, p, c, e, a, us) in enumerate(rows):
        t = epoch + dt.timedelta(microseconds=us)
        data.append((i, u, s, p, c, e, a, t.strftime("%Y-%m-%dT%H:%M:%S.%f") + "+00:00", t))
    df = spark.createDataFrame(
        data,
        "offset long, user_id string, session_id string, product_id string, category string, "
        "event_type string, amount double, timestamp string, expected timestamp",
    )
    decoded = valid_events(decode_records(encode_records(df, keep=("offset",)), keep=("offset",)), keep=("offset",))
    got = {r["offset"]: r for r in decoded.collect()}
    assert len(got) == len(data)
    for i, u, s, p, c, e, a, ts, t in data:
        r = got[i]
        assert (r["user_id"], r["session_id"], r["product_id"], r["category"], r["event_type"]) == (u, s, p, c, e)
        assert r["amount"] == a
        assert r["timestamp"] == ts and r["event_time"] == t


_CHARS = "0123456789-T:.Z+ zt/"
_mutation = st.tuples(st.integers(min_value=0, max_value=40), st.sampled_from(["set", "insert", "delete"]), st.sampled_from(list(_CHARS)))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    seeds=st.lists(st.tuples(micros, st.sampled_from(["Z", "+00:00", "-05:30", "+14:00", "+18:30"])), min_size=5, max_size=40),
    mutations=st.lists(st.lists(_mutation, max_size=3), min_size=40, max_size=40),
)
def test_positional_time_rule_agrees_with_regex_on_mutations(spark, seeds, mutations):
    """Random edits of valid timestamps: the positional strict rule and the
    regular-expression rule accept and parse exactly the same texts."""
    from pyspark.sql import functions as F

    from eventide.functions.decode import parse_event_time

    epoch = dt.datetime(1970, 1, 1)
    texts = []
    for (us, offset), edits in zip(seeds, mutations):
        t = list((epoch + dt.timedelta(microseconds=us)).strftime("%Y-%m-%dT%H:%M:%S.%f") + offset)
        texts.append("".join(t))
        for pos, kind, ch in edits:
            pos = min(pos, len(t))
            if kind == "set" and pos < len(t):
                t[pos] = ch
            elif kind == "insert":
                t.insert(pos, ch)
            elif kind == "delete" and pos < len(t):
                del t[pos]
        texts.append("".join(t))
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    out = df.select("t", _by_regex(F.col("t")).alias("r"), parse_event_time(F.col("t")).alias("p")).collect()
    for row in out:
        assert row["r"] == row["p"], row["t"]


def _by_regex(text):
    """The strict rule as a regular expression: six fraction digits and an offset."""
    from eventide.constants import EVENT_TIME_PATTERN

    return F.when(text.rlike(r"\.\d{6}(Z|[+-]\d{2}:\d{2})$"), F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERN)))
