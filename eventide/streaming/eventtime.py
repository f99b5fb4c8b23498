"""Event time and watermarks for streams.

Spark's ``withWatermark`` needs a ``timestamp`` (instant) column; epoch
numbers and ``timestamp_ntz`` (UTC wall clock) are converted first, without
depending on the session time zone.

* ascending timestamps (the surveyed default): ``delay="0 seconds"`` -
  a window [s, e) closes once an event at or after e has been seen;
* bounded out-of-orderness: ``delay="1 minute"`` / ``"3 seconds"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.predicates import wm_safe_filter
from eventide.timeutil import interval_str, ntz_to_instant, ts_type

__all__ = ["with_event_time", "wm_safe_filter"]


def with_event_time(df: DataFrame, ts: str = "ts", unit: str | None = None, delay="0 seconds",
                    out: str = "ts") -> DataFrame:
    c = F.col(ts)
    if unit in ("s", "sec", "seconds"):
        c = F.timestamp_seconds(c)
    elif unit in ("ms", "millis"):
        c = F.timestamp_millis(c)
    elif ts_type(df, ts) == "timestamp_ntz":
        c = ntz_to_instant(ts)
    return df.withColumn(out, c).withWatermark(out, interval_str(delay))
