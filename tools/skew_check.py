"""Hot-key check for the window aggregate.

Generates N events, forces one third of them into a single (window, category)
key, runs the flagship aggregate and reads Spark's event log (written to a
scratch folder) to report raw rows vs. shuffle records written by the partial
aggregation, and the largest reduce task's input.

    python tools/skew_check.py [N] [scratch_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    logdir = os.path.join(scratch, "eventlog")
    os.makedirs(logdir, exist_ok=True)

    from pyspark.sql import functions as F

    from eventide.operators import generate_events, tumbling_summary
    from eventide.session import build_session

    spark = build_session(
        "local[8]",
        shuffle_partitions=8,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": logdir,
            "spark.eventLog.compress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = generate_events(spark, n, partitions=32)
    hot = F.pmod(F.col("event_id"), F.lit(3)) == 0
    skewed = events.select(
        F.when(hot, F.lit("electronics")).otherwise(F.col("category")).alias("category"),
        "event_type",
        "amount",
        F.when(hot, F.lit("2024-01-01 00:00:30").cast("timestamp")).otherwise(F.col("event_time")).alias("event_time"),
    )
    spark.sparkContext.setJobGroup("skew", "hot-key aggregate")
    groups = tumbling_summary(skewed).count()
    spark.stop()

    written, read_max = 0, 0
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                written += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                r = m.get("Shuffle Read Metrics") or {}
                read_max = max(read_max, r.get("Total Records Read", 0))
    print(json.dumps({"events": n, "hot_key_rows": (n + 2) // 3, "groups": groups,
                      "shuffle_records_written": written, "max_records_read_by_one_task": read_max}))


if __name__ == "__main__":
    main()
