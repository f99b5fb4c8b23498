"""Event-time window counts.

All windows are epoch-aligned ``[start, end)`` and reported by exclusive
``window_end``, as Spark's ``window()`` does.

Sliding windows can be computed two ways:

* ``direct``: ``groupBy(window(ts, size, slide), keys)`` - every event is
  expanded into size/slide window rows before the partial aggregate;
* ``pane``: count slide-sized tumbling panes first (partial aggregate on the
  raw events), then expand each *pane count* into the size/slide windows that
  contain it and sum.  The expansion then scales with distinct (key, pane)
  pairs, not with events - 720x less work for 1 h / 5 s on dense keys.

* ``delta``: each pane count c becomes two change points, +c at the first
  window end that contains the pane and -c at the first that no longer does.
  A running sum over the change points (the bucketed, skew-safe
  ``ordered_scan``) is the window count between two change points, and the
  window rows are generated straight from those constant stretches.  No
  size/slide expansion is hashed at all: work is O(panes + output rows),
  which matters for 1 h / 5 s (720 windows per event).

``auto`` picks ``direct`` up to an expansion factor of 4, ``pane`` up to 48,
and ``delta`` beyond (size must be a multiple of slide for the latter two).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.scan import Running, ordered_scan, time_bucket
from eventide.timeutil import interval_str, seconds


def _direct(df, keys, ts, size, slide, out):
    w = F.window(F.col(ts), interval_str(size), interval_str(slide) if slide else None)
    return (df.groupBy(w.alias("_w"), *keys).agg(F.count(F.lit(1)).alias(out))
            .select(*keys, F.col("_w.end").alias("window_end"), out))


def _pane(df, keys, ts, size, slide, out):
    k = int(round(seconds(size) / seconds(slide)))
    step = seconds(slide)
    panes = (df.select(*keys, F.window(F.col(ts), interval_str(slide)).start.alias("_pane"))
             .groupBy(*keys, "_pane").agg(F.count(F.lit(1)).alias("_c")))
    ex = panes.select(*keys, "_pane", "_c", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_i"))
    end = F.col("_pane") + F.make_dt_interval(secs=(F.col("_i") * F.lit(step)).cast("decimal(18,6)"))
    return (ex.groupBy(*keys, end.alias("window_end")).agg(F.sum("_c").cast("bigint").alias(out)))


def _delta(df, keys, ts, size, slide, out, bucket="1 hour"):
    step = F.expr(f"INTERVAL {interval_str(slide)}")
    span = F.expr(f"INTERVAL {interval_str(size)}")
    panes = (df.select(*keys, F.window(F.col(ts), interval_str(slide)).start.alias("_pane"))
             .groupBy(*keys, "_pane").agg(F.count(F.lit(1)).alias("_c")))
    changes = panes.select(*keys, F.explode(F.array(
        F.struct((F.col("_pane") + step).alias("t"), F.col("_c").alias("d")),
        F.struct((F.col("_pane") + span + step).alias("t"), (-F.col("_c")).alias("d")))).alias("_x"))
    # read by each step of the scan: the plan shuffles it once and reuses that exchange
    merged = changes.groupBy(*keys, F.col("_x.t").alias("_t")).agg(F.sum("_x.d").alias("_d"))
    # a key has at most bucket / slide change points in a bucket
    s = ordered_scan(merged, keys, [F.col("_t")], time_bucket("_t", bucket), pos=None, running=[
        Running("_n", "sum", F.col("_d")),
        Running("_next", "min", F.col("_t"), inclusive=False, after=True)])
    live = s.filter(F.col("_n") > 0)
    return live.select(*keys, F.explode(F.sequence(F.col("_t"), F.col("_next") - step, step)).alias("window_end"),
                       F.col("_n").cast("bigint").alias(out))


def sliding_count(df: DataFrame, keys: list[str], size, slide, ts: str = "ts",
                  strategy: str = "auto", out: str = "cnt") -> DataFrame:
    """Count rows per (keys, sliding window) -> keys + window_end + out."""
    keys = list(keys)
    ratio = seconds(size) / seconds(slide)
    divisible = abs(ratio - round(ratio)) < 1e-9
    if strategy == "auto":
        strategy = "direct" if not divisible or ratio <= 4 else ("pane" if ratio <= 48 else "delta")
    if strategy in ("pane", "delta") and not divisible:
        raise ValueError(f"{strategy} strategy needs size to be a multiple of slide")
    if strategy == "pane":
        return _pane(df, keys, ts, size, slide, out)
    if strategy == "delta":
        return _delta(df, keys, ts, size, slide, out)
    return _direct(df, keys, ts, size, slide, out)


def tumbling_count(df: DataFrame, keys: list[str], size, ts: str = "ts", out: str = "cnt") -> DataFrame:
    """A3: count rows per (keys, tumbling window)."""
    return _direct(df, list(keys), ts, size, None, out)


def salted_count(df: DataFrame, keys: list[str], size, ts: str = "ts", salt_of: str = "seq",
                 n_salts: int = 10, out: str = "cnt") -> DataFrame:
    """A5: two-stage count - (window, keys, salt) first, then (window, keys).

    The salt is ``pmod(xxhash64(salt_of), n)``: deterministic, so a recomputed
    task after an executor loss lands every row in the same salt again.
    Spark's partial aggregation already removes count skew; this operator keeps
    the explicit form and must equal ``tumbling_count``.
    """
    keys = list(keys)
    salt = F.pmod(F.xxhash64(F.col(salt_of)), F.lit(n_salts))
    w = F.window(F.col(ts), interval_str(size))
    stage1 = (df.select(*keys, w.end.alias("window_end"), salt.alias("_salt"))
              .groupBy("window_end", *keys, "_salt").agg(F.count(F.lit(1)).alias("_c")))
    return (stage1.groupBy(*keys, "window_end").agg(F.sum("_c").cast("bigint").alias(out)))


def rollup_profile(counts: DataFrame, keys: list[str], cnt: str = "cnt") -> DataFrame:
    """Per key: number of windows, sum and max of the window counts."""
    return counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_windows"),
                                     F.sum(cnt).cast("bigint").alias("sum_cnt"),
                                     F.max(cnt).alias("max_cnt"))
