"""Batch late-row side output for sliding windows with allowed lateness (T4).

The watermark in front of an event is the largest event time of all events
that arrived before it (``seq`` order) minus the out-of-orderness ``delay``.
An event is late - routed to the side output - when every sliding window it
belongs to is already past the watermark plus ``lateness``; the last such
window ends at floor(ts / slide) * slide + size, so the test is
``last_end - 1 ms + lateness <= watermark``.

The arrival-order running max is the exclusive running max of the bucketed
``ordered_scan`` with no key: buckets of ``rows_per_bucket`` consecutive seq
numbers are scanned in parallel; only the one-row-per-bucket prefix runs
unpartitioned (10^12 events in 2^20-row buckets -> about 10^6 summary rows).  The watermark comes from *all* events (watermarks are
assigned before filtering), the late test applies to the rows that pass
``pred``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.scan import Running, ordered_scan
from eventide.timeutil import interval_str


class LateSplit(NamedTuple):
    on_time: DataFrame
    late: DataFrame


def _with_watermark(df: DataFrame, delay, ts: str, seq: str, tie: tuple[str, ...], rows_per_bucket: int) -> DataFrame:
    """Every row with the ``watermark`` in front of it (null for the first), in (seq, tie) order."""
    bucket = F.floor(F.col(seq) / F.lit(rows_per_bucket))
    s = ordered_scan(df, [], [F.col(c) for c in (seq, *tie)], bucket,
                     running=[Running("_maxts", "max", F.col(ts), inclusive=False)], pos=None)
    return s.withColumn("watermark", F.col("_maxts") - F.expr(f"INTERVAL {interval_str(delay)}"))


def split_late(df: DataFrame, size, slide, delay="1 minute", lateness="1 minute", ts: str = "ts",
               seq: str = "seq", pred: Column | None = None, rows_per_bucket: int = 1 << 20,
               tie: tuple[str, ...] = ()) -> LateSplit:
    """``seq`` is the order of arrival, a number; ``rows_per_bucket`` of its units are scanned by one task."""
    s = _with_watermark(df, delay, ts, seq, tie, rows_per_bucket)
    wm = F.col("watermark")
    last_end = F.window(F.col(ts), interval_str(slide)).start + F.expr(f"INTERVAL {interval_str(size)}")
    late_flag = F.coalesce(
        last_end - F.expr("INTERVAL 1 millisecond") + F.expr(f"INTERVAL {interval_str(lateness)}") <= wm,
        F.lit(False))
    s = s.withColumn("_late", late_flag)
    if pred is not None:
        s = s.filter(F.coalesce(pred, F.lit(False)))
    cols = df.columns
    return LateSplit(s.filter(~F.col("_late")).select(*cols),
                     s.filter(F.col("_late")).select(*cols, "watermark"))


def sliding_count_with_lateness(df: DataFrame, keys: list[str], size, slide, delay="1 minute", lateness="1 minute",
                                ts: str = "ts", seq: str = "seq", pred: Column | None = None,
                                rows_per_bucket: int = 1 << 20, tie: tuple[str, ...] = ()) -> DataFrame:
    """A10: final counts of sliding windows that take rows until ``lateness`` after the watermark passed their end.

    A row counts in those of its windows that are still open when it arrives: in all if it is on time, in none if it
    is late (``split_late``), in the last ones in between.  Windows no row was on time for do not appear."""
    s = _with_watermark(df, delay, ts, seq, tie, rows_per_bucket)
    if pred is not None:
        s = s.filter(F.coalesce(pred, F.lit(False)))
    w = s.select(*keys, "watermark", F.window(ts, interval_str(size), interval_str(slide)).end.alias("window_end"))
    closed = (F.col("window_end") - F.expr("INTERVAL 1 millisecond") + F.expr(f"INTERVAL {interval_str(lateness)}")
              <= F.col("watermark"))
    return (w.filter(~F.coalesce(closed, F.lit(False))).groupBy(*keys, "window_end")
            .agg(F.count(F.lit(1)).alias("cnt")))
