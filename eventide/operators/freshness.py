"""Summary freshness: is the streaming job still producing windows?

The data question behind a job-status check, asked of the data itself: the
newest closed window, its lag behind ``as_of`` and whether it is stale.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summary_freshness(
    summary: DataFrame,
    as_of: dt.datetime | str | Column | None = None,
    stale_after: str = "5 minutes",
) -> DataFrame:
    now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp"))
    last_end = F.max("window_end")
    lag = now.cast("double") - last_end.cast("double")
    return summary.agg(
        last_end.alias("last_window_end"),
        F.count(F.lit(1)).alias("summary_rows"),
        F.round(lag, 3).alias("lag_seconds"),
        F.coalesce(last_end < now - F.expr(f"INTERVAL {stale_after}"), F.lit(True)).alias("is_stale"),
    )
