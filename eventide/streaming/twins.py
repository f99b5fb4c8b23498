"""Streaming twins of the batch jobs, built from Spark's streaming operators.

Inputs are streaming DataFrames already passed through ``with_event_time``.
Every twin runs in append mode: a window's rows appear once the watermark
closes it, and equal the batch result for closed windows.

* sliding / tumbling counts: ``groupBy(window(ts, size, slide), keys)``; for
  small slides the pane form chains a second windowed aggregation over the
  pane's ``window_time`` ([V8]).
* top-N: ``row_number`` is not allowed on streams ([V1]); a processor keeps n
  rows per (window, key salt), then an aggregate merges at most salts * n
  candidates per window.
* distinct visitors: ``countDistinct`` is not allowed on streams; the
  two-level aggregation (window, user) -> window is exact ([V2]).
* matching: stream-stream full outer join on key + time range ([V9]); Spark
  bounds its state with the watermarks of both sides.
* filters after the watermark use ``wm_safe_filter`` so filtered-out rows
  still advance the watermark ([V3]).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.bitmap import DEFAULT_CAP, bitmap_offset
from eventide.streaming.processors import stream_least
from eventide.timeutil import interval_str, seconds


def stream_sliding_count(df: DataFrame, keys: list[str], size, slide=None, ts: str = "ts",
                         strategy: str = "direct", keep_window: bool = False) -> DataFrame:
    keys = list(keys)
    if strategy == "pane" and slide and seconds(size) != seconds(slide):
        panes = df.groupBy(F.window(ts, interval_str(slide)).alias("_p"), *keys).agg(F.count(F.lit(1)).alias("_c"))
        w = F.window(F.window_time("_p"), interval_str(size), interval_str(slide))
        agg = panes.groupBy(w.alias("window"), *keys).agg(F.sum("_c").cast("bigint").alias("cnt"))
    else:
        w = F.window(ts, interval_str(size), interval_str(slide) if slide else None)
        agg = df.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias("cnt"))
    cols = [*keys, F.col("window.end").alias("window_end"), "cnt"]
    return agg.select(*(["window"] if keep_window else []), *cols)


def stream_top_n(counts: DataFrame, n: int, key: str, salts: int = 32) -> DataFrame:
    """Per closed window, the first n of (count desc, key asc).

    ``row_number`` is not allowed on streams.  A processor per (window, xxhash64(key) mod ``salts``) reads its share
    of the window's counts once and holds n of them; an aggregate merges the at most salts * n candidates.
    ``counts``: key, cnt, window_end and the column Spark closes them by, ``closes`` or ``window``."""
    closes = F.col("closes") if "closes" in counts.columns else F.col("window.end")
    d = counts.select(F.unix_micros(closes).alias("_c"), F.unix_micros("window_end").alias("_e"),
                      F.pmod(F.xxhash64(F.col(key)), F.lit(salts)).alias("_salt"), F.col(key).alias("k"), "cnt")
    top = stream_least(d.groupBy("_c", "_e", "_salt"), n, counts.schema[key].dataType)
    pair = F.struct((-F.col("cnt")).alias("neg"), "k")
    best = (top.groupBy("at", "_e").agg(F.slice(F.sort_array(F.collect_list(pair)), 1, n).alias("_top"))
            .select(F.timestamp_micros("_e").alias("window_end"), F.posexplode("_top").alias("_i", "_p")))
    return best.select("window_end", (F.col("_i") + 1).cast("int").alias("rank"), F.col("_p.k").alias(key),
                       (-F.col("_p.neg")).alias("cnt"))


def stream_salted_count(df: DataFrame, size, salt_of: str = "seq", n_salts: int = 10, ts: str = "ts") -> DataFrame:
    salt = F.pmod(F.xxhash64(F.col(salt_of)), F.lit(n_salts))
    stage1 = df.groupBy(F.window(ts, interval_str(size)).alias("window"), salt.alias("_salt")).agg(
        F.count(F.lit(1)).alias("_c"))
    return (stage1.groupBy("window").agg(F.sum("_c").cast("bigint").alias("cnt"))
            .select(F.col("window.end").alias("window_end"), "cnt"))


def stream_unique_visitors(df: DataFrame, size="1 hour", user: str = "user_id", ts: str = "ts",
                           cap: int | None = None) -> DataFrame:
    u = bitmap_offset(user, cap or DEFAULT_CAP) if cap else F.col(user)
    lvl1 = df.groupBy(F.window(ts, interval_str(size)).alias("window"), u.alias("_u")).agg(F.count(F.lit(1)).alias("_n"))
    return (lvl1.groupBy("window").agg(F.count(F.lit(1)).alias("uv"))
            .select(F.col("window.end").alias("window_end"), "uv"))


def stream_unique_visitors_hll(df: DataFrame, size="1 hour", user: str = "user_id", ts: str = "ts") -> DataFrame:
    return (df.groupBy(F.window(ts, interval_str(size)).alias("window"))
            .agg(F.approx_count_distinct(user).alias("uv"))
            .select(F.col("window.end").alias("window_end"), "uv"))


def stream_interval_join(pays: DataFrame, receipts: DataFrame, key: str = "tx_id", bound="5 seconds") -> DataFrame:
    """Full outer stream-stream join; ``matched`` / ``unmatched_*`` are filters of it."""
    L = pays.select(F.col(key).alias("_lk"), *[F.col(c).alias("pay_" + c) for c in pays.columns if c != key])
    R = receipts.select(F.col(key).alias("_rk"), *[F.col(c).alias("receipt_" + c) for c in receipts.columns if c != key])
    iv = F.expr(f"INTERVAL {interval_str(bound)}")
    cond = ((F.col("_lk") == F.col("_rk")) & (F.col("receipt_ts") >= F.col("pay_ts") - iv)
            & (F.col("receipt_ts") <= F.col("pay_ts") + iv))
    j = L.join(R, cond, "full_outer")
    ch = (F.when(F.col("_lk").isNotNull() & F.col("_rk").isNotNull(), "matched")
          .when(F.col("_rk").isNull(), "unmatched_pays").otherwise("unmatched_receipts"))
    return j.select(F.coalesce("_lk", "_rk").alias(key), *[c for c in j.columns if c not in ("_lk", "_rk")],
                    ch.alias("channel"))


def stream_counts_with_lateness(raw: DataFrame, keys: list[str], size, slide, delay="1 minute",
                                lateness="1 minute", ts: str = "ts", mode: str = "append") -> tuple[DataFrame, str]:
    """A10: sliding counts whose windows accept rows up to ``lateness`` after they close.

    Spark has one watermark per stream, so allowed lateness folds into it:
    ``append`` -> watermark delay = delay + lateness, each window emitted once
    with its final value; ``update`` -> watermark delay = delay + lateness and
    every micro-batch re-emits the refined counts of open windows (the
    re-firing of the surveyed job, per micro-batch instead of per row).
    Returns the DataFrame and the output mode to start it with.
    """
    from eventide.streaming.eventtime import with_event_time
    d = with_event_time(raw, ts, delay=seconds(delay) + seconds(lateness))
    return stream_sliding_count(d, keys, size, slide), mode
