"""Per-key capping with a black-list side output (K1-K3).

A click passes while fewer than ``cap`` clicks of the same (keys, day) came
before it in (ts, seq) order; the click number ``cap + 1`` raises one warning
per (keys, day).  The day is the event-time calendar day shifted by
``day_offset_hours`` (8 -> days start at 00:00 UTC+8).

``row_number() <= cap + 1`` plans a partial WindowGroupLimit before the
shuffle, so each map task forwards at most cap + 1 rows per key: a hot
(user, ad) pair cannot flood a task.  Spark plans that limit only up to
``spark.sql.optimizer.windowGroupLimitThreshold``; for larger caps positions
come from the bucketed ``ordered_scan``, which splits a hot key's day.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.scan import ordered_scan, time_bucket
from eventide.timeutil import instant_to_ntz, ts_type

# Fixed value: the black-list message is "click over" + cap + "times".
BLACKLIST_MSG = "click over{cap}times"


class Capped(NamedTuple):
    passed: DataFrame
    warnings: DataFrame


def event_day(df: DataFrame, ts: str, offset_hours: int):
    t = F.col(ts) if ts_type(df, ts) == "timestamp_ntz" else instant_to_ntz(ts)
    return F.to_date(t + F.make_dt_interval(hours=F.lit(offset_hours)))


def cap_per_key(df: DataFrame, keys: list[str], cap: int = 100, ts: str = "ts", seq: str = "seq",
                day_offset_hours: int = 8) -> Capped:
    keys = list(keys)
    d = df.withColumn("day", event_day(df, ts, day_offset_hours))
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if cap + 1 <= limit:
        w = Window.partitionBy(*keys, "day").orderBy(F.col(ts), F.col(seq))
        d = d.withColumn("_rn", F.row_number().over(w))
    else:
        d = ordered_scan(d, [*keys, "day"], [F.col(ts), F.col(seq)], time_bucket(ts, "1 hour"), pos="_rn",
                         fine=time_bucket(ts, "1 second"))
    ranked = d.filter(F.col("_rn") <= cap + 1)
    passed = ranked.filter(F.col("_rn") <= cap).select(*df.columns)
    warnings = ranked.filter(F.col("_rn") == cap + 1).select(
        *keys, "day", F.col(ts).alias("warn_ts"), F.lit(BLACKLIST_MSG.format(cap=cap)).alias("msg"))
    return Capped(passed, warnings)


def blacklist_warnings(df: DataFrame, keys: list[str], cap: int = 100, **kw) -> DataFrame:
    """K2 on its own: one warning per (keys, day) at click number cap + 1."""
    return cap_per_key(df, keys, cap, **kw).warnings
