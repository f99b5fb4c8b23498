"""Sequence detection per key in (ts, seq) order.

Every detector works on (key, time bucket), so a hot key is spread over its
buckets; rows that matter to a neighbouring bucket are copied into it.

* consecutive runs (C1, C3, C4): a window over the last n events.
* bursts (C2): jumps of each bucket, followed per key, then folds from the
  true starts.
* followed-by (C5/C6): a running min over the later events.
* order status (C7): a per-order aggregate of min create / min pay times.
"""

from __future__ import annotations

import itertools
from collections import deque
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.scan import fold_groups
from eventide.timeutil import epoch_micros, epoch_micros_to_ntz, interval_str, seconds, ts_type

# Messages of the surveyed detectors.
PAIR_MSG = "login fail in {window}s for {n}tiems"
RUN_MSG = "login fail {n} times in 2s"
BURST_MSG = "login fail in {window}s for {n}tiems"
PAYED = "payed"
TIMEOUT = "timeout"
STATUS_PAYED_OK = "payed successfully"
STATUS_PAYED_LATE = "payed but timeout"
STATUS_TIMEOUT = "timeout"
STATUS_PAY_FIRST = "pay successfully"
STATUS_NO_CREATE = "payed but not found create"


def time_buckets(df: DataFrame, ts: str, width, reach=None, copy: Column | None = None, ahead: bool = True) -> DataFrame:
    """Rows with the start ``_b`` (epoch microseconds) of their time bucket; with ``reach``, rows for which ``copy``
    holds and that lie within ``reach`` of the next bucket (``ahead``; else of the one before) are copied into it,
    marked ``_ghost``.  A bucket is at least ``reach`` wide, so rows no further apart than that always meet."""
    micros = int(round(max(seconds(width), seconds(reach or 0)) * 1_000_000))
    d = df.withColumn("_t", epoch_micros(ts, ts_type(df, ts)))
    start = F.col("_t") - F.pmod(F.col("_t"), F.lit(micros))
    if reach is None:
        return d.withColumn("_b", start).drop("_t")
    near = int(round(seconds(reach) * 1_000_000))
    edge = F.col("_t") >= start + (micros - near) if ahead else F.col("_t") <= start + near
    own = F.struct(start.alias("b"), F.lit(False).alias("g"))
    other = F.struct((start + micros if ahead else start - micros).alias("b"), F.lit(True).alias("g"))
    if copy is not None:
        edge = edge & copy
    d = d.withColumn("_s", F.explode(F.when(edge, F.array(own, other)).otherwise(F.array(own))))
    return d.select("*", F.col("_s.b").alias("_b"), F.col("_s.g").alias("_ghost")).drop("_s", "_t")


def consecutive_run(df: DataFrame, n: int = 8, key: str = "user_id",
                    pred: Column | None = None, within=None, inclusive: bool = True,
                    ts: str = "ts", seq: str = "seq", bucket="1 hour", msg: str | None = None) -> DataFrame:
    """Every run of ``n`` directly consecutive matching events (overlapping matches).

    A run of r matching events yields r - n + 1 rows (first and last event
    time).  ``within`` bounds last - first (inclusive ``<=`` or strict ``<``).

    A window over (key, time bucket) decides each row by its last n rows, so a
    hot key is spread over its buckets.  With ``within`` the rows that far in
    front of a bucket are copied into it: one shuffle.  Without it, the first
    n - 1 rows of a bucket need rows from any time before; they are decided by
    a second window, per key, over the first and last n - 1 rows of each
    bucket alone, between which no row that matters is left out.
    """
    pred = F.col("login_state") == "fail" if pred is None else pred
    is_hit = F.coalesce(pred, F.lit(False))
    text = msg if msg is not None else (
        PAIR_MSG.format(window=int(seconds(within)), n=n) if within is not None else RUN_MSG.format(n=n))
    d = df.select(key, ts, seq, is_hit.alias("_hit"))
    d = time_buckets(d, ts, bucket, within if n > 1 else None)
    order = [F.col(ts), F.col(seq)]

    def runs(rows, *keys):
        last_n = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)
        return rows.withColumns({"_n": F.sum(F.col("_hit").cast("int")).over(last_n),
                                 "first_fail_ts": F.first(F.col(ts)).over(last_n)})

    found = F.col("_hit") & (F.col("_n") == n)
    out = [key, "first_fail_ts", F.col(ts).alias("last_fail_ts"), F.lit(text).alias("msg")]
    if within is not None:
        end = F.col("first_fail_ts") + F.expr(f"INTERVAL {interval_str(within)}")
        near = F.col(ts) <= end if inclusive else F.col(ts) < end
        mine = ~F.col("_ghost") if n > 1 else F.lit(True)
        return runs(d, key, "_b").filter(found & near & mine).select(*out)
    inside = runs(d, key, "_b").filter(found)
    if n == 1:
        return inside.select(*out)
    in_bucket = Window.partitionBy(key, "_b")
    edge = (d.withColumns({"_rn": F.row_number().over(in_bucket.orderBy(*order)),
                           "_rows": F.count(F.lit(1)).over(in_bucket)})
            .filter((F.col("_rn") < n) | (F.col("_rn") > F.col("_rows") - (n - 1))))
    across = runs(edge, key).filter(found & (F.col("_rn") < n))
    return inside.select(*out).unionByName(across.select(*out))


def consecutive_pairs(df: DataFrame, window="2 seconds", key: str = "user_id", pred: Column | None = None,
                      inclusive: bool = True, **kw) -> DataFrame:
    """C1 (inclusive) / C4 (strict): a fail directly after a fail within ``window``."""
    return consecutive_run(df, 2, key, pred, within=window, inclusive=inclusive, **kw)


def burst_jumps(rows, window: int, end: int):
    """Where each possible start leaves a time bucket that ends at ``end``: (open burst at its start, open burst at
    its end) by anchor time, None being no open burst.  Rows in order: (t, is_fail, is_own); those not own are the
    fails in front of the bucket that a burst may still be open from.  One pair for all starts if they agree.

    Starts whose burst is over by a fail go on together from it, so the chains only ever merge.
    """
    chains, own = deque([(None, [None])]), False
    for t, fail, mine in rows:
        if not mine:
            if fail and chains[-1][0] != t:
                chains.append((t, [t]))
            continue
        own = True
        if not fail:
            chains = deque([(None, [s for _, starts in chains for s in starts])])
            continue
        merged = None
        while chains and (chains[0][0] is None or chains[0][0] < t - window):
            starts = chains.popleft()[1]
            if merged is None:
                merged = starts
            else:
                big, small = (merged, starts) if len(merged) > len(starts) else (starts, merged)
                big.extend(small)
                merged = big
        if merged is not None:
            chains.append((t, merged))
    if not own:
        return
    left = [(None if a is None or a + window < end else a, starts) for a, starts in chains]
    if len({a for a, _ in left}) == 1:
        yield None, left[0][0], True
    else:
        for a, starts in left:
            for s in starts:
                yield s, a, False


def burst_starts(rows, width: int):
    """(bucket, open burst at its start) of one key, by following the jumps from bucket to bucket; only where a burst
    is open.  Rows in order of bucket: (bucket, start, end, for all starts)."""
    last, state = None, None
    for bucket, jumps in itertools.groupby(rows, key=lambda r: r[0]):
        jumps = {None if whole else s: (e, whole) for _, s, e, whole in jumps}
        state = state if last == bucket - width else None
        if state is not None:
            yield bucket, state
        whole = jumps[None][1]
        state = jumps[None if whole or state not in jumps else state][0]
        last = bucket


def burst_rows(rows, window: int, min_fails: int, opened: int | None):
    """(first, last, fails) of the bursts that begin in a bucket.  Rows in order: (t, is_fail, is_own); those not own
    lie behind the bucket.  ``opened``: the burst open at its start, which an earlier bucket reports."""
    anchor, last, n = opened, None, 0
    for t, fail, own in rows:
        if anchor is not None and t > anchor + window:
            if n >= min_fails:
                yield anchor, last, n
            anchor, n = None, 0
        if not fail:
            anchor, n = None, 0
        elif anchor is None and own:
            anchor, last, n = t, t, 1
        elif anchor is not None and n:
            last, n = t, n + 1
    if anchor is not None and n >= min_fails:
        yield anchor, last, n


def fail_bursts(df: DataFrame, window="2 seconds", min_fails: int = 2, key: str = "user_id",
                pred: Column | None = None, ts: str = "ts", seq: str = "seq", bucket="1 hour") -> DataFrame:
    """Greedy bursts.  The first fail at t opens a burst of the fails in
    [t, t + window]; a success in that range discards it; at t + window the
    burst is reported if it holds at least ``min_fails`` fails.  The next burst
    starts at the next fail after that.  End of input closes an open burst.

    Which fail opens a burst depends on all before it, so a key is cut into time
    buckets, and its bursts are found in three lazy steps: every bucket says where
    each burst that may be open at its start leads (``burst_jumps``; mostly all to
    one place); per key these jumps, a row or few per bucket, are followed in order
    (``burst_starts``); every bucket reports its bursts from its true start
    (``burst_rows``).  The first and last step work on (key, bucket) with rows
    streamed in order, so a key that fails without pause is split, and no step
    holds more than the fails of one window length.
    """
    pred = F.col("login_state") == "fail" if pred is None else pred
    w = int(seconds(window))
    reach = int(round(seconds(window) * 1_000_000))
    width = int(round(max(seconds(bucket), seconds(window)) * 1_000_000))
    ntz = ts_type(df, ts) == "timestamp_ntz"
    d = df.select(F.col(key), epoch_micros(ts, ts_type(df, ts)).alias("t"), F.col(seq).alias("s"),
                  F.coalesce(pred, F.lit(False)).alias("fail")).filter(F.col("t").isNotNull())
    d = d.withColumn("b", F.col("t") - F.pmod(F.col("t"), F.lit(width)))

    def with_edge(edge, shift):
        own = F.struct(F.col("b").alias("b"), F.lit(True).alias("own"))
        copy = F.struct((F.col("b") + shift).alias("b"), F.lit(False).alias("own"))
        e = F.explode(F.when(edge, F.array(own, copy)).otherwise(F.array(own))).alias("_e")
        return d.select(key, "t", "s", "fail", e).select(key, F.col("_e.b").alias("b"), "t", "s", "fail", F.col("_e.own").alias("own"))

    key_field = T.StructField("k", df.schema[key].dataType)

    def long(*names):
        return [T.StructField(n, T.LongType()) for n in names]

    def jumps(group, rows):
        k, b = group
        for start, end, whole in burst_jumps(((t, f, own) for _, _, t, _, f, own in rows), reach, b + width):
            yield k, b, start, end, whole

    def starts(group, rows):
        for b, a in burst_starts(((b, s, e, whole) for _, b, s, e, whole in rows), width):
            yield group[0], b, a

    def bursts(group, rows):
        first = next(rows)
        opened = first[2] if first[4] is None else None
        rest = rows if first[4] is None else itertools.chain([first], rows)
        for a, z, n in burst_rows(((t, f, own) for _, _, t, _, f, own in rest), reach, min_fails, opened):
            yield group[0], a, z, n

    before = with_edge(F.col("fail") & (F.col("t") >= F.col("b") + (width - reach)), width)
    j = fold_groups(before, [key, "b"], ["t", "s"], jumps,
                    T.StructType([key_field, *long("b", "start", "end"), T.StructField("whole", T.BooleanType())]))
    opened = fold_groups(j, ["k"], ["b"], starts, T.StructType([key_field, *long("b", "t")]))
    opened = opened.select(F.col("k").alias(key), "b", "t", F.lit(None).cast(df.schema[seq].dataType).alias("s"),
                           F.lit(None).cast("boolean").alias("fail"), F.lit(False).alias("own"))
    behind = with_edge(F.col("t") <= F.col("b") + reach, -width).unionByName(opened)
    found = fold_groups(behind, [key, "b"], ["t", F.col("s").asc_nulls_first()], bursts,
                        T.StructType([key_field, *long("a", "z", "n")]))
    at = epoch_micros_to_ntz if ntz else F.timestamp_micros
    return found.select(F.col("k").alias(key), at(F.col("a")).alias("first_fail_ts"), at(F.col("z")).alias("last_fail_ts"),
                        F.col("n").cast("int").alias("fail_count"),
                        F.concat(F.lit(f"login fail in {w}s for "), F.col("n").cast("string"), F.lit("tiems")).alias("msg"))


class FollowedBy(NamedTuple):
    matched: DataFrame
    timeouts: DataFrame


def followed_by(df: DataFrame, within="15 minutes", key: str = "order_id",
                first: Column | None = None, then: Column | None = None, ts: str = "ts", seq: str = "seq",
                bucket="1 hour") -> FollowedBy:
    """Each ``first`` event matched with the first later ``then`` event of its
    key if it comes less than ``within`` after it; otherwise a timeout at first + within.

    Only a ``then`` less than ``within`` away decides, so one that close behind a time
    bucket is copied into it, and a running min over (key, bucket), latest event first,
    finds it: one read, one shuffle, and a hot key spread over its buckets.
    """
    first = F.col("event_type") == "create" if first is None else first
    then = F.col("event_type") == "pay" if then is None else then
    d = df.select(key, ts, seq, F.coalesce(first, F.lit(False)).alias("_first"), F.coalesce(then, F.lit(False)).alias("_then"))
    d = time_buckets(d.filter(F.col("_first") | F.col("_then")), ts, bucket, within, F.col("_then"), ahead=False)
    later = (Window.partitionBy(key, "_b").orderBy(F.col(ts).desc(), F.col(seq).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("pay_ts", F.min(F.when(F.col("_then"), F.col(ts))).over(later))
    j = d.filter(F.col("_first") & ~F.col("_ghost")).select(key, F.col(ts).alias("create_ts"), "pay_ts")
    deadline = F.col("create_ts") + F.expr(f"INTERVAL {interval_str(within)}")
    ok = F.coalesce(F.col("pay_ts") < deadline, F.lit(False))
    matched = j.filter(ok).select(key, "create_ts", "pay_ts", F.lit(PAYED).alias("result"))
    timeouts = j.filter(~ok).select(key, "create_ts", deadline.alias("timeout_ts"),
                                    F.lit(TIMEOUT).alias("result"))
    return FollowedBy(matched, timeouts)


def order_payment_status(df: DataFrame, timeout="15 minutes", key: str = "order_id",
                         ts: str = "ts") -> DataFrame:
    """C7 batch spec: one row per order from c = first create, p = first pay."""
    et = F.col("event_type")
    g = df.groupBy(key).agg(F.min(F.when(et == "create", F.col(ts))).alias("create_ts"),
                            F.min(F.when(et == "pay", F.col(ts))).alias("pay_ts"))
    c, p = F.col("create_ts"), F.col("pay_ts")
    deadline = c + F.expr(f"INTERVAL {interval_str(timeout)}")
    state = (F.when(c.isNotNull() & p.isNotNull() & (p >= c) & (p < deadline), STATUS_PAYED_OK)
             .when(c.isNotNull() & p.isNotNull() & (p >= c), STATUS_PAYED_LATE)
             .when(c.isNotNull() & p.isNotNull(), STATUS_PAY_FIRST)
             .when(c.isNotNull(), STATUS_TIMEOUT)
             .otherwise(STATUS_NO_CREATE))
    channel = F.when(state.isin(STATUS_PAYED_OK, STATUS_PAY_FIRST), "main").otherwise("side")
    return g.select(key, "create_ts", "pay_ts", state.alias("result"), channel.alias("channel"))
