"""Connector option maps, JDBC upsert statements, config and the test-data
adapter's JSON round trip."""

from __future__ import annotations

import pytest

from eventide.config import JobConfig
from eventide.sources.kafka import sample_records, sink_options, source_options
from eventide.streaming.sinks import JdbcUpsertSink, upsert_sql

from .conftest import SF001


def test_kafka_source_options():
    cfg = JobConfig(kafka_bootstrap="b:9092", kafka_topic="t", kafka_group_id="g")
    o = source_options(cfg, min_partitions=24, max_offsets_per_trigger=1000)
    assert o == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "groupIdPrefix": "g",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "24",
    }
    assert source_options(cfg, exact_group_id=True)["kafka.group.id"] == "g"
    assert source_options(cfg, starting_offsets="earliest")["startingOffsets"] == "earliest"
    assert source_options(cfg, fail_on_data_loss=False)["failOnDataLoss"] == "false"
    assert "failOnDataLoss" not in source_options(cfg)


def test_kafka_sink_options():
    o = sink_options(JobConfig(kafka_bootstrap="b:1", kafka_topic="t"))
    assert o["kafka.acks"] == "all" and o["kafka.retries"] == "3" and o["topic"] == "t"


def test_config_from_env_and_password_rule():
    cfg = JobConfig.from_env({"WINDOW_MINUTES": "7", "KAFKA_TOPIC": "x", "POSTGRES_PASSWORD": "s3cr3t-pw"})
    assert cfg.window_minutes == 7 and cfg.window_duration == "7 minutes" and cfg.kafka_topic == "x"
    assert "s3cr3t-pw" not in repr(cfg) and cfg.jdbc_password == "s3cr3t-pw"
    with pytest.raises(KeyError):
        JobConfig.from_env({}, require_password=True)


def test_upsert_statements():
    pg = upsert_sql("jdbc:postgresql://h/db", "analytics_summary", "stage_1")
    assert pg.startswith('INSERT INTO analytics_summary ("window_start", "window_end", "category"')
    assert 'ON CONFLICT ("window_start", "category") DO UPDATE SET "window_end" = EXCLUDED."window_end"' in pg
    merge = upsert_sql("jdbc:derby:memory:x", "S", "STAGE")
    assert merge.startswith('MERGE INTO S t USING STAGE s ON t."window_start" = s."window_start" AND t."category" = s."category"')
    assert "WHEN NOT MATCHED THEN INSERT" in merge
    with pytest.raises(ValueError):
        upsert_sql("jdbc:postgresql://h/db", "x; DROP TABLE y", "s")


def test_jdbc_sink_staging_names():
    sink = JdbcUpsertSink("jdbc:postgresql://h/db", "analytics_summary", {"user": "u"}, query_tag="q1")
    assert sink.staging_table(12) == "analytics_summary_stage_q1_12"


def test_sample_is_first_records_by_partition_offset(spark):
    from eventide.functions.encode import encode_records
    from eventide.sources.testdata import events_to_wire, read_table

    out = encode_records(sample_records(events_to_wire(read_table(spark, SF001, "events")), 5)).collect()
    assert [(r["partition"], r["offset"]) for r in out] == [(0, i) for i in range(5)]
    assert all(r["value"].startswith('{"user_id":"user_') for r in out)


def test_wire_round_trip_keeps_every_row(spark):
    from eventide.functions.decode import decode_records, valid_events
    from eventide.sources.testdata import events_as_records, read_table

    n = read_table(spark, SF001, "events").count()
    v = valid_events(decode_records(events_as_records(read_table(spark, SF001, "events"))))
    assert v.count() == n
    assert v.where("event_time IS NULL OR category IS NULL OR amount IS NULL").count() == 0


def test_freshness_flags_a_stale_summary(spark):
    import datetime as dt

    from eventide.operators import summary_freshness

    t = dt.datetime(2024, 1, 1)
    s = spark.createDataFrame(
        [(t, t + dt.timedelta(minutes=1), "a", 1, 0, 0.0)],
        "window_start timestamp, window_end timestamp, category string, event_count long, purchase_count long, total_revenue double",
    )
    fresh = summary_freshness(s, as_of=t + dt.timedelta(minutes=3)).first()
    stale = summary_freshness(s, as_of=t + dt.timedelta(hours=1)).first()
    assert (fresh["is_stale"], fresh["lag_seconds"]) == (False, 120.0)
    assert stale["is_stale"] is True
    empty = summary_freshness(s.limit(0), as_of=t).first()
    assert empty["is_stale"] is True and empty["summary_rows"] == 0


def test_declared_schemas_match_the_frames(spark):
    from eventide.functions.decode import decode_records, valid_events
    from eventide.operators import tumbling_summary
    from eventide.schema import EVENT_SCHEMA, SUMMARY_SCHEMA, WIRE_RECORD_SCHEMA
    from eventide.sources.testdata import events_as_records, events_to_wire, read_table

    def shape(schema):
        return [(f.name, f.dataType) for f in schema.fields]

    wire = events_to_wire(read_table(spark, SF001, "events")).drop("partition", "offset", "event_id")
    assert shape(wire.schema) == shape(WIRE_RECORD_SCHEMA)
    events = valid_events(decode_records(events_as_records(read_table(spark, SF001, "events"))))
    assert shape(events.schema) == shape(EVENT_SCHEMA)
    assert shape(tumbling_summary(events).schema) == shape(SUMMARY_SCHEMA)


def test_jdbc_upsert_sink_flow_without_a_database(spark, monkeypatch):
    """Executors' writes and the driver's statements, with the database
    replaced by recorders (no database can run in this environment)."""
    import datetime as dt

    from pyspark.sql.readwriter import DataFrameWriter

    writes, statements = [], []

    def fake_jdbc(self, url, table, mode=None, properties=None):
        writes.append((table, mode, dict(properties or {}), self._df.count()))

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    original_init = DataFrameWriter.__init__

    def init(self, df):
        original_init(self, df)
        self._df = df

    monkeypatch.setattr(DataFrameWriter, "__init__", init)
    t = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame(
        [(t, t, "a", 2, 1, 3.0), (t, t, None, 1, 0, 0.0)],
        "window_start timestamp, window_end timestamp, category string, event_count long, purchase_count long, total_revenue double",
    )
    sink = JdbcUpsertSink("jdbc:postgresql://h/db", "analytics_summary", {"user": "u"}, query_tag="q", execute=statements.extend)
    sink(batch, 5)
    assert writes[0][:2] == ("analytics_summary_stage_q_5", "overwrite") and writes[0][3] == 1
    assert writes[0][2]["batchsize"] == "100" and writes[0][2]["numPartitions"] == "8"
    assert writes[1][:2] == ("analytics_summary_stage_q_5_rejects", "overwrite") and writes[1][3] == 1
    assert statements[0].startswith("INSERT INTO analytics_summary") and "FROM analytics_summary_stage_q_5" in statements[0]
    assert statements[1] == "DELETE FROM analytics_summary_rejects WHERE \"run\" = 'q' AND \"batch_id\" = 5"
    assert statements[2].startswith("INSERT INTO analytics_summary_rejects") and statements[2].endswith("FROM analytics_summary_stage_q_5_rejects")
    assert statements[3:] == ["DROP TABLE analytics_summary_stage_q_5", "DROP TABLE analytics_summary_stage_q_5_rejects"]
    first = list(statements)
    sink(batch, 5)  # replayed: the same statements, which replace what the first attempt left
    assert statements == first * 2 and all(w[1] == "overwrite" for w in writes)
    with pytest.raises(ValueError):
        JdbcUpsertSink("jdbc:postgresql://h/db", "t", {}, query_tag="q'; --")


def test_jdbc_scan_derives_partition_bounds(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameReader

    from eventide.sources.jdbc import read_summary_jdbc

    calls = []

    def fake_jdbc(self, url, table, column=None, lowerBound=None, upperBound=None, numPartitions=None, properties=None, **kw):
        calls.append((table, column, lowerBound, upperBound, numPartitions))
        if "MIN(\"window_start\")" in table:
            return spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-30 23:59:00")], "lo string, hi string")
        return spark.range(1)

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_jdbc)
    read_summary_jdbc(spark, "jdbc:postgresql://h/db", "analytics_summary", {"user": "u"}, num_partitions=16)
    assert calls[0][0] == '(SELECT MIN("window_start") AS "lo", MAX("window_start") AS "hi" FROM analytics_summary) bounds'
    assert calls[1] == ("analytics_summary", "window_start", "2024-01-01 00:00:00", "2024-01-30 23:59:00", 16)
    calls.clear()
    read_summary_jdbc(spark, "jdbc:postgresql://h/db", "analytics_summary", {"user": "u"})
    assert calls == [("analytics_summary", None, None, None, None)]


def test_summary_ddl(spark):
    from eventide.streaming.sinks import summary_ddl

    pg = summary_ddl("jdbc:postgresql://h/db", "analytics_summary")
    assert pg.startswith("CREATE TABLE IF NOT EXISTS analytics_summary (")
    assert '"window_start" TIMESTAMPTZ NOT NULL' in pg and '"category" TEXT NOT NULL' in pg
    assert '"event_count" BIGINT DEFAULT 0' in pg and '"total_revenue" DOUBLE PRECISION DEFAULT 0.0' in pg
    assert pg.endswith('PRIMARY KEY ("window_start", "category"))')
    other = summary_ddl("jdbc:derby:memory:x", "S")
    assert other.startswith("CREATE TABLE S (") and '"window_start" TIMESTAMP NOT NULL' in other
    statements = []
    JdbcUpsertSink("jdbc:postgresql://h/db", "analytics_summary", {}, execute=statements.extend).ensure_table(spark)
    assert statements[0] == pg
    assert statements[1] == 'CREATE INDEX IF NOT EXISTS idx_analytics_summary_window ON analytics_summary ("window_start" DESC)'
    assert statements[2] == 'CREATE INDEX IF NOT EXISTS idx_analytics_summary_category ON analytics_summary ("category")'
    assert statements[3].startswith("CREATE TABLE IF NOT EXISTS analytics_summary_rejects (") and "NOT NULL" not in statements[3]


class _Recorder:
    """Stands in for a Spark reader/writer: records format and options."""

    def __init__(self, result=None):
        self.calls, self.result = [], result

    def format(self, f):
        self.calls.append(("format", f))
        return self

    def options(self, **o):
        self.calls.append(("options", o))
        return self

    def load(self):
        self.calls.append(("load",))
        return self.result

    def save(self):
        self.calls.append(("save",))


def test_kafka_readers_and_writer_use_the_option_maps(spark, monkeypatch):
    from pyspark.sql import SparkSession

    from eventide.sources import kafka

    cfg = JobConfig(kafka_bootstrap="b:9092", kafka_topic="t", kafka_group_id="g")
    rec = _Recorder(result="df")
    monkeypatch.setattr(SparkSession, "read", property(lambda self: rec))
    assert kafka.kafka_batch(spark, cfg) == "df"
    opts = rec.calls[1][1]
    assert rec.calls[0] == ("format", "kafka") and opts["startingOffsets"] == "earliest" and opts["endingOffsets"] == "latest"

    kafka.kafka_batch(spark, cfg, end={1: 5, 0: 7})
    assert rec.calls[4][1]["endingOffsets"] == '{"t": {"0": 7, "1": 5}}'

    srec = _Recorder(result="stream")
    monkeypatch.setattr(SparkSession, "readStream", property(lambda self: srec))
    assert kafka.kafka_stream(spark, cfg, min_partitions=64) == "stream"
    assert srec.calls[1][1]["minPartitions"] == "64" and srec.calls[1][1]["startingOffsets"] == "latest"

    wrec = _Recorder()
    df = spark.createDataFrame([("{}",)], "value string")
    monkeypatch.setattr(type(df), "write", property(lambda self: wrec))
    kafka.write_kafka(df, cfg)
    assert wrec.calls[0] == ("format", "kafka") and wrec.calls[1][1]["kafka.acks"] == "all" and wrec.calls[-1] == ("save",)


def test_record_stream_sink_writes_json_lines(spark, workdir):
    from eventide.functions.encode import encode_records
    from eventide.operators import generate_events
    from eventide.sources.files import json_lines_stream
    from eventide.streaming.sinks import start_record_sink, write_json_lines

    write_json_lines(encode_records(generate_events(spark, 300, 2), keep=()), f"{workdir}/src")
    q = start_record_sink(
        json_lines_stream(spark, f"{workdir}/src"), f"{workdir}/chk", path=f"{workdir}/out", trigger={"availableNow": True}
    )
    q.awaitTermination()
    out = spark.read.text(f"{workdir}/out")
    assert out.count() == 300 and out.where("value NOT LIKE '{\"user_id\":%'").count() == 0
