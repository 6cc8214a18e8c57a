"""Command line: the streaming job, the report and the event generator.

    python -m eventide stream   --sink parquet --path P --checkpoint C [--source kafka|files --input DIR]
    python -m eventide stream   --sink jdbc --checkpoint C            (POSTGRES_* from the environment)
    (add --available-now to process what is available and stop)
    python -m eventide report   --table P [--keyed] | --jdbc   [--as-of TS] [--period "1 hour"] [--limit 100] [--out DIR]
    python -m eventide query    [latest] [revenue] [windows] --table P [--keyed] | --jdbc
    python -m eventide generate --events N (--out DIR | --kafka) [--partitions K]

Configuration comes from the environment (KAFKA_BOOTSTRAP_SERVERS,
KAFKA_TOPIC, KAFKA_GROUP_ID, POSTGRES_URL, POSTGRES_USER, POSTGRES_PASSWORD,
WINDOW_MINUTES). The report's lines come from Spark one partition at a time;
all aggregation runs in Spark.
"""

from __future__ import annotations

import argparse

from .config import JobConfig
from .constants import REPORT_LIMIT, REPORT_PERIOD, REPORT_TITLE
from .session import build_session


def _stream(args, spark) -> None:
    from .sources.files import json_lines_stream
    from .sources.jdbc import jdbc_properties
    from .sources.kafka import kafka_stream
    from .streaming.job import start_from_config
    from .streaming.progress import ProgressLog
    from .streaming.sinks import JdbcUpsertSink, KeyedSummaryTable

    cfg = JobConfig.from_env(require_password=args.sink == "jdbc")
    how = {"available_now": args.available_now, "observe_quality": args.observe_quality}
    if args.progress:
        spark.streams.addListener(ProgressLog(spark, args.progress))
    if args.source == "kafka":
        records = kafka_stream(
            spark, cfg, min_partitions=args.min_partitions, max_offsets_per_trigger=args.max_offsets_per_trigger, exact_group_id=args.exact_group_id
        )
    else:
        records = json_lines_stream(spark, args.input, max_files_per_trigger=args.max_files_per_trigger)
    if args.sink == "jdbc":
        if not cfg.jdbc_url:
            raise SystemExit("POSTGRES_URL is not set")
        sink = JdbcUpsertSink(cfg.jdbc_url, cfg.summary_table, jdbc_properties(cfg.jdbc_user, cfg.jdbc_password), batch_size=cfg.jdbc_batch_size)
        sink.ensure_table(spark)
        query = start_from_config(records, cfg, args.checkpoint, sink, **how)
    elif args.sink == "table":
        query = start_from_config(records, cfg, args.checkpoint, KeyedSummaryTable(args.path), **how)
    else:
        query = start_from_config(records, cfg, args.checkpoint, "parquet", args.path, **how)
    query.awaitTermination()


def _summary_source(args, spark):
    from .streaming.sinks import KeyedSummaryTable

    if args.jdbc:
        from .sources.jdbc import jdbc_properties, read_summary_jdbc

        cfg = JobConfig.from_env(require_password=True)
        if not cfg.jdbc_url:
            raise SystemExit("POSTGRES_URL is not set")
        props = jdbc_properties(cfg.jdbc_user, cfg.jdbc_password)
        return read_summary_jdbc(spark, cfg.jdbc_url, cfg.summary_table, props, num_partitions=args.jdbc_partitions)
    if not args.table:
        raise SystemExit("give --table or --jdbc")
    return KeyedSummaryTable(args.table).read(spark) if args.keyed else spark.read.parquet(args.table)


def _query(args, spark) -> None:
    """The three ad-hoc queries: latest rows, revenue by category, events per
    window. Each result is bounded (10, one per category, 10 rows)."""
    from .operators import events_per_window, latest, revenue_by_category

    summary = _summary_source(args, spark)
    chosen = {
        "latest": ("Latest 10 rows (most recent first)", latest),
        "revenue": ("Revenue by category (all time)", revenue_by_category),
        "windows": ("Events per window (last 10 windows)", events_per_window),
    }
    for name in args.which or list(chosen):
        title, op = chosen[name]
        print(title)
        op(summary).show(truncate=False)


def _report(args, spark) -> None:
    from .operators import formatted, last_period

    summary = _summary_source(args, spark)
    report = last_period(summary, as_of=args.as_of, period=args.period, limit=args.limit or None)
    if args.out:
        # For dashboards: the rows and the one-row totals as tables.
        from .operators import totals

        report.write.mode("overwrite").parquet(f"{args.out}/rows")
        totals(report).write.mode("overwrite").parquet(f"{args.out}/totals")
        return
    title = REPORT_TITLE if args.period == REPORT_PERIOD else REPORT_TITLE.replace("60 Minutes", args.period)
    for row in formatted(report, title).orderBy("section", "line_no").toLocalIterator():
        print(row["line"])


def _generate(args, spark) -> None:
    from .functions.encode import encode_records
    from .operators import generate_events
    from .sources.kafka import write_kafka
    from .streaming.sinks import write_json_lines

    records = encode_records(generate_events(spark, args.events, args.partitions), keep=())
    if getattr(args, "kafka", False):
        write_kafka(records, JobConfig.from_env())  # unkeyed, acks=all, 3 retries
    else:
        write_json_lines(records, args.out)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="eventide")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--source", choices=["kafka", "files"], default="kafka")
    s.add_argument("--input")
    s.add_argument("--sink", choices=["parquet", "table", "jdbc"], default="table")
    s.add_argument("--path")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--min-partitions", type=int)
    s.add_argument("--exact-group-id", action="store_true", help="use KAFKA_GROUP_ID itself and not as a prefix")
    s.add_argument("--max-offsets-per-trigger", type=int, help="records in a micro-batch at most (Kafka)")
    s.add_argument("--max-files-per-trigger", type=int, help="files in a micro-batch at most (files)")
    s.add_argument("--observe-quality", action="store_true", help="count rejected and weakened records in each micro-batch")
    s.add_argument("--progress", help="append every progress update as parquet here")
    s.add_argument("--available-now", action="store_true", help="process what is available, then stop (backfill)")
    r = sub.add_parser("report")
    q = sub.add_parser("query")
    q.add_argument("which", nargs="*", choices=["latest", "revenue", "windows"])
    for sp in (r, q):
        sp.add_argument("--table", help="parquet summary (or keyed table with --keyed)")
        sp.add_argument("--keyed", action="store_true", help="table written by the keyed sink")
        sp.add_argument("--jdbc", action="store_true", help="read the summary table from the database (POSTGRES_*)")
        sp.add_argument("--jdbc-partitions", type=int, default=8)
    r.add_argument("--as-of")
    r.add_argument("--period", default="1 hour")
    r.add_argument("--limit", type=int, default=REPORT_LIMIT, help="rows printed at most; 0 prints the whole period")
    r.add_argument("--out", help="write rows and totals as parquet here instead of printing")
    g = sub.add_parser("generate")
    g.add_argument("--events", type=int, required=True)
    g.add_argument("--out", help="folder for JSON-lines files")
    g.add_argument("--kafka", action="store_true", help="send to KAFKA_TOPIC instead (needs the Kafka connector)")
    g.add_argument("--partitions", type=int)
    args = p.parse_args(argv)
    if args.cmd == "generate" and not (args.out or args.kafka):
        p.error("generate needs --out or --kafka")
    spark = build_session(app_name=f"eventide-{args.cmd}")
    {"stream": _stream, "report": _report, "query": _query, "generate": _generate}[args.cmd](args, spark)


if __name__ == "__main__":
    main()
