"""Time-bounded matching of two keyed streams.

A left event (pay) and a right event (receipt) can match when they share the key
and their times differ by at most ``bound`` (inclusive).

* pairing ``all`` (default): every pair in range.  The join is on the key and a time
  bucket as wide as the bound, in which one side is entered three times, so a hot key
  is spread over its buckets and a row only meets rows near its time.
* ``first``: each side keeps the first event of every key, by (time, order), and those
  two match if they are in range; later events of a key are not looked at.
* ``one``: one-to-one, first come first served.  Events of a key are taken in time
  order (left before right, then by order); each is paired with the longest waiting
  event of the other side that is still in range, or waits itself.  No pair spans a
  silence of the key longer than the bound, so the stretches between silences are
  matched independently, each in one pass over its sorted rows that holds only the
  waiting ones.

With unique keys per side the three agree.  Unmatched events of either side are
returned as named side outputs.  The streaming twins are a stream-stream full outer
join (``all``) and ``stream_one_to_one`` (``one``).
"""

from __future__ import annotations

import math
from collections import deque
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.scan import Running, fold_groups, ordered_scan, time_bucket
from eventide.operators.sequences import time_buckets
from eventide.timeutil import epoch_micros, interval_str, ntz_to_epoch_seconds, seconds, ts_type


class Matched(NamedTuple):
    matched: DataFrame
    unmatched_left: DataFrame
    unmatched_right: DataFrame


def _bucket(df: DataFrame, ts: str, width: int):
    since = ntz_to_epoch_seconds(ts) if df.schema[ts].dataType.typeName() == "timestamp_ntz" else F.unix_seconds(ts)
    return F.floor(since / width)


def first_come_pairs(events, bound: int):
    """(left, right) pairs and unmatched (left, None) / (None, right) of one stretch; events: (time, side, payload)
    in order, side 0 being left."""
    waiting, side_waiting = deque(), 0
    for t, side, payload in events:
        while waiting and waiting[0][0] < t - bound:
            old = waiting.popleft()[1]
            yield (None, old) if side_waiting else (old, None)
        if waiting and side_waiting != side:
            other = waiting.popleft()[1]
            yield (payload, other) if side == 0 else (other, payload)
        else:
            waiting.append((t, payload))
            side_waiting = side
    for _, old in waiting:
        yield (None, old) if side_waiting else (old, None)


def _one_to_one(left: DataFrame, right: DataFrame, key: str, bound, left_ts: str, right_ts: str,
                left_order: list[str], right_order: list[str]) -> DataFrame:
    """Columns _l and _r, structs of the paired rows (null: unmatched)."""
    def side(df, ts, number, mine, other, theirs):
        row = F.struct(*[F.col(c) for c in df.columns])
        return df.select(F.col(key).cast("string").alias("_k"), F.col(ts).alias("_ts"), F.lit(number).alias("_side"),
                         row.alias(mine), F.lit(None).cast(other.schema).alias(theirs))

    both = side(left, left_ts, 0, "_l", right, "_r").unionByName(side(right, right_ts, 1, "_r", left, "_l"))
    ties = [F.col(f"_l.{c}") for c in left_order] + [F.col(f"_r.{c}") for c in right_order]
    lone = both.filter(F.col("_k").isNull() | F.col("_ts").isNull()).select("_l", "_r")
    both = both.filter(F.col("_k").isNotNull() & F.col("_ts").isNotNull())
    both = both.withColumn("_us", epoch_micros("_ts", ts_type(both, "_ts")))
    reach = int(round(seconds(bound) * 1_000_000))
    # a silence before a row: the last one before it, itself or copied from the bucket before, is out of reach
    d = time_buckets(both, "_ts", "1 hour", bound)
    before = F.max("_us").over(Window.partitionBy("_k", "_b").orderBy("_us").rowsBetween(
        Window.unboundedPreceding, -1))
    d = (d.withColumn("_silence", before.isNull() | (F.col("_us") > before + reach)).filter(~F.col("_ghost"))
         .drop("_b", "_ghost"))
    d = ordered_scan(d, ["_k"], [F.col("_us"), F.col("_side"), *ties], time_bucket("_ts", "1 hour"), pos=None,
                     running=[Running("_start", "max", F.when(F.col("_silence"), F.col("_us")))])
    d = d.select("_k", "_start", "_us", "_side", "_l", "_r")

    def pairs(_, stretch):
        return first_come_pairs(((us, side, r if side else x) for _, _, us, side, x, r in stretch), reach)

    paired = fold_groups(d, ["_k", "_start"], ["_us", "_side", *ties], pairs,
                         T.StructType([T.StructField("_l", left.schema), T.StructField("_r", right.schema)]))
    return paired.unionByName(lone)


def _firsts(df: DataFrame, key: str, ts: str, order: list[str]) -> DataFrame:
    """The first row of every key, by partial aggregation; rows without key or time stay as they are."""
    rest = [c for c in df.columns if c not in (key, ts, *order)]
    whole = F.col(key).isNotNull() & F.col(ts).isNotNull()
    least = (df.filter(whole).groupBy(key).agg(F.min(F.struct(ts, *order, *rest)).alias("_f"))
             .select(key, "_f.*").select(*df.columns))
    return least.unionByName(df.filter(~whole))


def interval_match(left: DataFrame, right: DataFrame, key: str = "tx_id", bound="5 seconds",
                   left_ts: str = "ts", right_ts: str = "ts", left_order: list[str] | None = None,
                   right_order: list[str] | None = None, left_prefix: str = "pay_",
                   right_prefix: str = "receipt_", pairing: str = "all") -> Matched:
    """Pairs and unmatched rows of both sides (see the module for ``pairing``).

    Times within the bound lie in the same or in neighbouring buckets, and each pair meets in the right (for
    ``unmatched_right`` the left) event's own bucket only, so no pair comes twice.  Repeated rows count each; null
    keys and times match nothing.  ``left_order`` and ``right_order`` break ties of time for ``first`` and ``one``.
    """
    if pairing not in ("all", "first", "one"):
        raise ValueError(f"unknown pairing {pairing!r}")
    if pairing == "one":
        p = _one_to_one(left, right, key, bound, left_ts, right_ts, left_order or [], right_order or [])
        lcols = [F.col(f"_l.{c}").alias(left_prefix + c) for c in left.columns if c != key]
        rcols = [F.col(f"_r.{c}").alias(right_prefix + c) for c in right.columns if c != key]
        lkey, rkey = F.col(f"_l.{key}").alias(key), F.col(f"_r.{key}").alias(key)
        both, no_l, no_r = F.col("_l").isNotNull() & F.col("_r").isNotNull(), F.col("_l").isNull(), F.col("_r").isNull()
        return Matched(p.filter(both).select(lkey, *lcols, *rcols), p.filter(no_r).select(lkey, *lcols),
                       p.filter(no_l).select(rkey, *rcols))
    if pairing == "first":
        left, right = _firsts(left, key, left_ts, left_order or []), _firsts(right, key, right_ts, right_order or [])
    width = max(1, math.ceil(seconds(bound)))
    L = left.select(F.col(key).alias("_lk"), _bucket(left, left_ts, width).alias("_lb"),
                    *[F.col(c).alias(left_prefix + c) for c in left.columns if c != key])
    R = right.select(F.col(key).alias("_rk"), _bucket(right, right_ts, width).alias("_rb"),
                     *[F.col(c).alias(right_prefix + c) for c in right.columns if c != key])
    lt, rt = F.col(left_prefix + left_ts), F.col(right_prefix + right_ts)
    iv = F.expr(f"INTERVAL {interval_str(bound)}")
    near = ((F.col("_lk") == F.col("_rk")) & (F.col("_lb") == F.col("_rb")) & (rt >= lt - iv) & (rt <= lt + iv))

    def thrice(df, b):
        return df.withColumn(b, F.explode(F.array(F.col(b) - 1, F.col(b), F.col(b) + 1)))

    lnames, rnames = L.columns[2:], R.columns[2:]
    matched = thrice(L, "_lb").join(R, near).select(F.col("_lk").alias(key), *lnames, *rnames)
    unl = L.join(thrice(R, "_rb"), near, "left_anti").select(F.col("_lk").alias(key), *lnames)
    unr = R.join(thrice(L, "_lb"), near, "left_anti").select(F.col("_rk").alias(key), *rnames)
    return Matched(matched, unl, unr)
