"""Stateful processors for the streaming twins of the sequence operators.

Used only where a stream needs per-key state with event-time timers
(``transformWithState``, Row API, RocksDB state store).  Keys are spread over
the cluster by Spark's hash partitioning of the grouping key; each processor
keeps a small bounded state per key (a buffer of not-yet-final events, the
last n-1 fails, or two timestamps) and clears it by timer.

Rows inside one micro-batch are not ordered, and a row may arrive before
older rows: events are buffered until the watermark passes them, then handled
in (ts, seq) order, so the output equals the batch operator on events behind
the watermark.
"""

from __future__ import annotations

import bisect
import calendar
import datetime as dt
import heapq
import itertools
from collections import deque

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventide.operators.sequences import (PAIR_MSG, RUN_MSG, STATUS_NO_CREATE, STATUS_PAY_FIRST, STATUS_PAYED_LATE,
                                          STATUS_PAYED_OK, STATUS_TIMEOUT)
from eventide.timeutil import instant_to_ntz, seconds

_EV = T.StructType([T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()),
                    T.StructField("hit", T.BooleanType())])
_TS = T.StructType([T.StructField("ts", T.LongType())])

# Event times come as epoch microseconds (column t) and go out as aware datetimes: no local zone in between.
_EPOCH_UTC = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _dt(us: int) -> dt.datetime:
    return _EPOCH_UTC + dt.timedelta(microseconds=us)


def _ms(us: int) -> int:
    """Timer / watermark resolution is milliseconds."""
    return us // 1000


class _BufferedProcessor(StatefulProcessor):
    """Buffers a key's events until the watermark passes them, then hands them
    over in (ts, seq) order to ``on_events``; ``on_watermark`` runs after.

    One timer is pending for the whole buffer, at its earliest event; when it
    goes off, all events the watermark has passed are taken at once.  So the
    buffer is read and sorted once per watermark step, not once per event."""

    fields: T.StructType

    def init(self, handle):
        self.h = handle
        self.buf = handle.getListState("buf", self.fields)
        self.alarm = handle.getValueState("alarm", _TS)
        self.setup(handle)

    def setup(self, handle):
        pass

    def row_values(self, r) -> tuple:
        raise NotImplementedError

    def _set_alarm(self, us: int) -> None:
        old = self.alarm.get()[0] if self.alarm.exists() else None
        if old is None or _ms(us) < old:
            if old is not None:
                self.h.deleteTimer(old)
            self.h.registerTimer(_ms(us))
            self.alarm.update((_ms(us),))

    def handleInputRows(self, key, rows, timerValues):
        new = [self.row_values(r) for r in rows]
        if new:
            self.buf.appendList(new)
            self._set_alarm(min(v[0] for v in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        out = []
        if self.alarm.exists() and self.alarm.get()[0] <= wm:
            self.alarm.clear()
            items = sorted(tuple(x) for x in self.buf.get()) if self.buf.exists() else []
            cut = bisect.bisect_right(items, wm, key=lambda x: _ms(x[0]))
            self.buf.clear()
            if items[cut:]:
                self.buf.put(items[cut:])
                self._set_alarm(items[cut][0])
            if cut:
                out += self.on_events(key, items[:cut], wm)
        out += self.on_watermark(key, wm)
        return iter(out)

    def on_events(self, key, events, wm):
        return []

    def on_watermark(self, key, wm):
        return []

    def close(self):
        pass


class ConsecutiveRunProcessor(_BufferedProcessor):
    """Runs of n consecutive matching events, optionally within a bound."""

    fields = _EV

    def __init__(self, n: int, within=None, inclusive: bool = True, column: str = "login_state",
                 value: str = "fail", msg: str | None = None):
        self.n, self.inclusive, self.column, self.value = n, inclusive, column, value
        self.within_ms = None if within is None else int(seconds(within) * 1000)
        self.msg = msg or (PAIR_MSG.format(window=int(seconds(within)), n=n) if within is not None
                           else RUN_MSG.format(n=n))

    def setup(self, handle):
        self.recent = handle.getListState("recent", _TS)

    def row_values(self, r):
        return (r.t, r.seq, r[self.column] == self.value)

    def on_events(self, key, events, wm):
        recent = [x[0] for x in self.recent.get()] if self.recent.exists() else []
        out = []
        for t, _, hit in events:
            if not hit:
                recent = []
                continue
            recent.append(t)
            if len(recent) >= self.n:
                first = recent[-self.n]
                w = None if self.within_ms is None else self.within_ms * 1000
                ok = w is None or (t - first <= w if self.inclusive else t - first < w)
                if ok:
                    out.append(Row(user_id=key[0], first_fail_ts=_dt(first), last_fail_ts=_dt(t), msg=self.msg))
            recent = recent[-(self.n - 1):] if self.n > 1 else []
        self.recent.clear()
        if recent:
            self.recent.put([(t,) for t in recent])
            if self.within_ms is not None:
                # past last event + within no earlier fail can pair with a later one: drop the run state
                self.h.registerTimer(_ms(recent[-1]) + self.within_ms + 1)
        return out

    def on_watermark(self, key, wm):
        if self.within_ms is not None and not self.buf.exists() and self.recent.exists():
            if _ms(max(x[0] for x in self.recent.get())) + self.within_ms < wm:
                self.recent.clear()
        return []


RUN_SCHEMA = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("first_fail_ts", T.TimestampType()),
                           T.StructField("last_fail_ts", T.TimestampType()), T.StructField("msg", T.StringType())])


def stream_consecutive_run(logins: DataFrame, n: int = 8, within=None, inclusive: bool = True) -> DataFrame:
    """Streaming twin of ``consecutive_run`` / ``consecutive_pairs`` (input already watermarked)."""
    return (logins.select("user_id", "seq", "login_state", "ts", F.unix_micros("ts").alias("t")).groupBy("user_id")
            .transformWithState(ConsecutiveRunProcessor(n, within, inclusive), RUN_SCHEMA, "Append", "EventTime"))


class OrderStatusProcessor(StatefulProcessor):
    """One outcome per order.

    * create and pay seen: decided at once by the batch rule;
    * create only: ``timeout`` when the watermark passes create + timeout; the
      order then stays as a tombstone for another ``timeout`` so a pay arriving
      in that time yields ``payed but timeout`` (a second, side-channel row);
    * pay only: wait until the watermark passes the pay; then ``payed but not
      found create``.
    """

    def __init__(self, timeout="15 minutes"):
        self.timeout_ms = int(seconds(timeout) * 1000)

    def init(self, handle):
        self.h = handle
        self.st = handle.getValueState("st", T.StructType([
            T.StructField("c", T.LongType()), T.StructField("p", T.LongType()), T.StructField("done", T.BooleanType())]))

    def _emit(self, key, c, p, result):
        ch = "main" if result in (STATUS_PAYED_OK, STATUS_PAY_FIRST) else "side"
        return Row(order_id=key[0], create_ts=None if c is None else _dt(c), pay_ts=None if p is None else _dt(p),
                   result=result, channel=ch)

    def handleInputRows(self, key, rows, timerValues):
        c, p, done = self.st.get() if self.st.exists() else (None, None, False)
        for r in rows:
            t = r.t
            if r.event_type == "create":
                c = t if c is None else min(c, t)
            elif r.event_type == "pay":
                p = t if p is None else min(p, t)
        out = []
        if done:
            if p is not None and c is not None:
                out.append(self._emit(key, c, p, STATUS_PAYED_LATE))
                self.st.clear()
                return iter(out)
        elif c is not None and p is not None:
            if p < c:
                res = STATUS_PAY_FIRST
            elif p - c < self.timeout_ms * 1000:
                res = STATUS_PAYED_OK
            else:
                res = STATUS_PAYED_LATE
            for t in self.h.listTimers():
                self.h.deleteTimer(t)
            self.st.clear()
            return iter([self._emit(key, c, p, res)])
        elif c is not None:
            self.h.registerTimer(_ms(c) + self.timeout_ms)
        elif p is not None:
            self.h.registerTimer(_ms(p))
        self.st.update((c, p, done))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.st.exists():
            return iter([])
        c, p, done = self.st.get()
        if done:
            self.st.clear()
            return iter([])
        if c is not None:
            self.st.update((c, None, True))
            self.h.registerTimer(_ms(c) + 2 * self.timeout_ms)
            return iter([self._emit(key, c, None, STATUS_TIMEOUT)])
        self.st.clear()
        return iter([self._emit(key, None, p, STATUS_NO_CREATE)])

    def close(self):
        pass


STATUS_SCHEMA = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("create_ts", T.TimestampType()),
                              T.StructField("pay_ts", T.TimestampType()), T.StructField("result", T.StringType()),
                              T.StructField("channel", T.StringType())])


def stream_order_payment_status(orders: DataFrame, timeout="15 minutes") -> DataFrame:
    return (orders.select("order_id", "event_type", "ts", F.unix_micros("ts").alias("t")).groupBy("order_id")
            .transformWithState(OrderStatusProcessor(timeout), STATUS_SCHEMA, "Append", "EventTime"))


class CapProcessor(_BufferedProcessor):
    """K1/K2 per (user, ad, day): pass the first ``cap`` clicks, warn once on click cap + 1.

    Clicks are buffered until the watermark passes them and counted in
    (ts, seq) order; at most cap + 1 clicks of a day are held, and its state
    is dropped by a timer after it ends."""

    def __init__(self, cap: int = 100, msg: str = "click over{cap}times", day_offset_hours: int = 8):
        self.cap, self.msg, self.offset = cap, msg.format(cap=cap), day_offset_hours

    fields = T.StructType([T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()),
                           T.StructField("province", T.StringType()), T.StructField("city", T.StringType())])

    def setup(self, handle):
        self.n = handle.getValueState("n", T.StructType([T.StructField("n", T.LongType())]))

    def _day_end_ms(self, day: dt.date) -> int:
        nxt = dt.datetime.combine(day + dt.timedelta(days=1), dt.time()) - dt.timedelta(hours=self.offset)
        return calendar.timegm(nxt.timetuple()) * 1000

    def handleInputRows(self, key, rows, timerValues):
        self.buf.appendList([(r.t, r.seq, r.province, r.city) for r in rows])
        # a click behind the first cap + 1 of the day can only move further back: it is never output
        left = max(0, self.cap + 1 - (self.n.get()[0] if self.n.exists() else 0))
        held = sorted(tuple(x) for x in self.buf.get())
        if len(held) > left:
            self.buf.clear()
            if left:
                self.buf.put(held[:left])
        for t, *_ in held[:left][:1]:  # one timer for the buffer, at its first click
            self._set_alarm(t)
        self.h.registerTimer(self._day_end_ms(key[2]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        user, ad, day = key
        wm = timerValues.getCurrentWatermarkInMs()
        if expiredTimerInfo.getExpiryTimeInMs() >= self._day_end_ms(day) and not self.buf.exists():
            self.n.clear()  # the day is over: drop its state
            return iter([])
        items = sorted(tuple(x) for x in self.buf.get()) if self.buf.exists() else []
        ready = [x for x in items if _ms(x[0]) <= wm]
        rest = [x for x in items if _ms(x[0]) > wm]
        self.buf.clear()
        self.alarm.clear()
        if rest:
            self.buf.put(rest)
            self._set_alarm(rest[0][0])
        n = self.n.get()[0] if self.n.exists() else 0
        out = []
        for t, seq, prov, city in ready:
            n += 1
            if n <= self.cap:
                out.append(Row(channel="main", seq=seq, user_id=user, ad_id=ad, province=prov, city=city, ts=_dt(t),
                               day=day, msg=None))
            elif n == self.cap + 1:
                out.append(Row(channel="blacklist", seq=seq, user_id=user, ad_id=ad, province=prov, city=city,
                               ts=_dt(t), day=day, msg=self.msg))
        self.n.update((n,))
        return iter(out)

    def close(self):
        pass


CAP_SCHEMA = T.StructType([T.StructField("channel", T.StringType()), T.StructField("seq", T.LongType()),
                           T.StructField("user_id", T.LongType()), T.StructField("ad_id", T.LongType()),
                           T.StructField("province", T.StringType()), T.StructField("city", T.StringType()),
                           T.StructField("ts", T.TimestampType()), T.StructField("day", T.DateType()),
                           T.StructField("msg", T.StringType())])


def stream_cap_per_key(clicks: DataFrame, cap: int = 100, day_offset_hours: int = 8) -> DataFrame:
    """Streaming twin of ``cap_per_key``; split the result with ``split_channels(['main', 'blacklist'])``."""
    day = F.to_date(instant_to_ntz("ts") + F.make_dt_interval(hours=F.lit(day_offset_hours)))
    return (clicks.select("user_id", "ad_id", day.alias("day"), "seq", "province", "city", "ts", F.unix_micros("ts").alias("t"))
            .groupBy("user_id", "ad_id", "day")
            .transformWithState(CapProcessor(cap, day_offset_hours=day_offset_hours), CAP_SCHEMA, "Append",
                                "EventTime"))


class FollowedByProcessor(_BufferedProcessor):
    """Every create matched with the first later pay if it comes less than
    ``within`` after it; otherwise a timeout once the watermark passes the deadline."""

    fields = T.StructType([T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()),
                           T.StructField("kind", T.StringType())])

    def __init__(self, within="15 minutes", first: str = "create", then: str = "pay"):
        self.w_us = int(seconds(within) * 1_000_000)
        self.first, self.then = first, then

    def setup(self, handle):
        self.pending = handle.getListState("pending", _TS)

    def row_values(self, r):
        return (r.t, r.seq, r.event_type)

    def _row(self, key, c, p, result):
        return Row(order_id=key[0], create_ts=_dt(c), end_ts=_dt(p if p is not None else c + self.w_us),
                   result=result)

    def on_events(self, key, events, wm):
        pend = [x[0] for x in self.pending.get()] if self.pending.exists() else []
        out = []
        for t, _, kind in events:
            if kind == self.first:
                pend.append(t)
                self.h.registerTimer(_ms(t + self.w_us))
            elif kind == self.then and pend:
                for c in pend:
                    out.append(self._row(key, c, t, "payed") if t - c < self.w_us else self._row(key, c, None, "timeout"))
                pend = []
        self.pending.clear()
        if pend:
            self.pending.put([(c,) for c in pend])
        return out

    def on_watermark(self, key, wm):
        pend = [x[0] for x in self.pending.get()] if self.pending.exists() else []
        due = [c for c in pend if _ms(c + self.w_us) <= wm]
        if not due:
            return []
        keep = [c for c in pend if c not in due]
        self.pending.clear()
        if keep:
            self.pending.put([(c,) for c in keep])
        return [self._row(key, c, None, "timeout") for c in due]


FOLLOWED_SCHEMA = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("create_ts", T.TimestampType()),
                                T.StructField("end_ts", T.TimestampType()), T.StructField("result", T.StringType())])


def stream_followed_by(orders: DataFrame, within="15 minutes") -> DataFrame:
    """Streaming twin of ``followed_by``: ``result`` is ``payed`` (end_ts = pay time) or
    ``timeout`` (end_ts = create + within); split with ``split_channels(..., column='result')``."""
    return (orders.select("order_id", "seq", "event_type", "ts", F.unix_micros("ts").alias("t")).groupBy("order_id")
            .transformWithState(FollowedByProcessor(within), FOLLOWED_SCHEMA, "Append", "EventTime"))


class BurstProcessor(_BufferedProcessor):
    """Greedy fail bursts; a burst closes when the watermark passes anchor + window."""

    fields = _EV

    def __init__(self, window="2 seconds", min_fails: int = 2, column: str = "login_state", value: str = "fail"):
        self.w_us = int(seconds(window) * 1_000_000)
        self.wsec = int(seconds(window))
        self.min, self.column, self.value = min_fails, column, value

    def setup(self, handle):
        self.st = handle.getValueState("st", T.StructType([
            T.StructField("anchor", T.LongType()), T.StructField("last", T.LongType()), T.StructField("cnt", T.IntegerType())]))

    def row_values(self, r):
        return (r.t, r.seq, r[self.column] == self.value)

    def _emit(self, key, a, last, cnt):
        return Row(user_id=key[0], first_fail_ts=_dt(a), last_fail_ts=_dt(last), fail_count=cnt,
                   msg=f"login fail in {self.wsec}s for {cnt}tiems")

    def on_events(self, key, events, wm):
        a, last, cnt = self.st.get() if self.st.exists() else (None, None, 0)
        out = []
        for t, _, hit in events:
            if a is not None and t > a + self.w_us:
                if cnt >= self.min:
                    out.append(self._emit(key, a, last, cnt))
                a, last, cnt = None, None, 0
            if not hit:
                a, last, cnt = None, None, 0
                continue
            if a is None:
                a, cnt = t, 0
                self.h.registerTimer(_ms(t + self.w_us))
            last, cnt = t, cnt + 1
        if a is None:
            self.st.clear()
        else:
            self.st.update((a, last, cnt))
        return out

    def on_watermark(self, key, wm):
        if not self.st.exists():
            return []
        a, last, cnt = self.st.get()
        if _ms(a + self.w_us) > wm:
            return []
        self.st.clear()
        return [self._emit(key, a, last, cnt)] if cnt >= self.min else []


BURST_SCHEMA = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("first_fail_ts", T.TimestampType()),
                             T.StructField("last_fail_ts", T.TimestampType()), T.StructField("fail_count", T.IntegerType()),
                             T.StructField("msg", T.StringType())])


def stream_fail_bursts(logins: DataFrame, window="2 seconds", min_fails: int = 2) -> DataFrame:
    return (logins.select("user_id", "seq", "login_state", "ts", F.unix_micros("ts").alias("t")).groupBy("user_id")
            .transformWithState(BurstProcessor(window, min_fails), BURST_SCHEMA, "Append", "EventTime"))


class FirstSightingProcessor(StatefulProcessor):
    """D4 per (window end, offset salt): the first sighting of every bit offset, handed on when the watermark passes
    the end of its time bucket, after which no earlier one can come."""

    def __init__(self, bucket):
        self.bucket = int(round(seconds(bucket) * 1_000_000))

    def init(self, handle):
        self.h = handle
        offset = T.StructType([T.StructField("o", T.LongType())])
        self.seen = handle.getMapState("seen", offset, T.StructType([T.StructField("b", T.BooleanType())]))
        self.new = handle.getMapState("new", offset, T.StructType([
            T.StructField("t", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("user_id", T.LongType())]))
        self.timer = handle.getValueState("timer", _TS)

    def _end(self, t: int) -> int:
        return t - t % self.bucket + self.bucket

    def _wait(self, ends) -> None:
        """One timer: the end of the first open bucket, at last that of the window."""
        due = -(-min(ends) // 1000)
        old = self.timer.get()[0] if self.timer.exists() else None
        if old is None or due < old:
            if old is not None:
                self.h.deleteTimer(old)
            self.h.registerTimer(due)
            self.timer.update((due,))

    def handleInputRows(self, key, rows, timerValues):
        first = {}
        for r in rows:
            e = (r.t, r.seq, r.user_id)
            if r.bit_offset not in first or e[:2] < first[r.bit_offset][:2]:
                first[r.bit_offset] = e
        ends = [key[0]]
        for offset, e in first.items():
            if self.seen.containsKey((offset,)):
                continue
            if self.new.containsKey((offset,)) and tuple(self.new.getValue((offset,)))[:2] <= e[:2]:
                continue
            self.new.updateValue((offset,), e)
            ends.append(self._end(e[0]))
        self._wait(ends)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        out, ends = [], []
        for (offset,), (t, seq, user) in list(self.new.iterator()):
            end = self._end(t)
            if end > wm:
                ends.append(end)
                continue
            out.append(Row(at=_EPOCH_UTC + dt.timedelta(microseconds=end - 1), _w=key[0], bit_offset=offset, t=t, seq=seq,
                           user_id=user))
            self.new.removeKey((offset,))
            self.seen.updateValue((offset,), (True,))
        if key[0] <= wm:
            self.seen.clear()
        else:
            self._wait([key[0], *ends])
        return iter(out)

    def close(self):
        pass


_SIGHTING = T.StructType([T.StructField("at", T.TimestampType())]
                         + [T.StructField(c, T.LongType()) for c in ("_w", "bit_offset", "t", "seq", "user_id")])


def stream_first_sightings(pv: DataFrame, size="1 hour", cap: int = 1 << 29, bucket="1 second",
                           salts: int = 32) -> DataFrame:
    """window_end, bit_offset, ts, seq, user_id of the first row of every bit offset in every window, once the
    watermark has passed its time bucket.  No group holds more than one salt of a window's visitors."""
    from eventide.functions.bitmap import bitmap_offset
    from eventide.timeutil import interval_str
    offset = bitmap_offset("user_id", cap)
    d = pv.select(F.unix_micros(F.window("ts", interval_str(size)).end).alias("_w"), "ts", offset.alias("bit_offset"),
                  F.unix_micros("ts").alias("t"), "seq", "user_id")
    d = d.withColumn("_salt", F.pmod(F.xxhash64("bit_offset"), F.lit(salts)))
    out = d.groupBy("_w", "_salt").transformWithState(FirstSightingProcessor(bucket), _SIGHTING, "Append", "EventTime")
    return out.select(F.timestamp_micros("_w").alias("window_end"), "bit_offset", F.timestamp_micros("t").alias("ts"),
                      "seq", "user_id", "at")


class LeastProcessor(StatefulProcessor):
    """K0 per (closing time, window end, salt): the n first of (count desc, key asc), n rows of state."""

    def __init__(self, n: int, key_type: T.DataType):
        self.n, self.key_type = n, key_type

    def init(self, handle):
        self.h = handle
        self.best = handle.getListState("best", T.StructType([T.StructField("cnt", T.LongType()),
                                                              T.StructField("k", self.key_type)]))

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(x) for x in self.best.get()] if self.best.exists() else []
        pairs = itertools.chain(held, ((r.cnt, r.k) for r in rows))
        self.best.put(heapq.nsmallest(self.n, pairs, key=lambda p: (-p[0], p[1] is not None, p[1])))
        self.h.registerTimer(_ms(key[0]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        out = [Row(at=_EPOCH_UTC + dt.timedelta(microseconds=key[0] - 1), _e=key[1], cnt=n, k=k)
               for n, k in (self.best.get() if self.best.exists() else [])]
        self.best.clear()
        return iter(out)

    def close(self):
        pass


def stream_least(grouped, n: int, key_type: T.DataType) -> DataFrame:
    """``grouped`` by (closing micros, window end micros, salt), with columns k and cnt.  ``at``: event time."""
    schema = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("_e", T.LongType()),
                           T.StructField("cnt", T.LongType()), T.StructField("k", key_type)])
    return grouped.transformWithState(LeastProcessor(n, key_type), schema, "Append", "EventTime",
                                      eventTimeColumnName="at")


class OneToOneProcessor(_BufferedProcessor):
    """J1 one-to-one per key: each event, once the watermark has passed it, pairs with the longest waiting event of
    the other side in range, or waits; one that waited for ``bound`` goes out unmatched.  Only one side waits."""

    def __init__(self, bound, event: T.StructType):
        self.bound, self.fields = int(seconds(bound) * 1_000_000), event

    def setup(self, handle):
        self.waiting = handle.getListState("waiting", self.fields)

    def row_values(self, r):
        return tuple(r[f.name] for f in self.fields)

    def _row(self, key, pay, receipt):
        names = [f.name for f in self.fields[3:]]
        values = {c: None for c in [*names, "pay_t", "receipt_t"]}
        for e, side in ((pay, "pay_"), (receipt, "receipt_")):
            if e:
                values.update({c: v for c, v in zip(names, e[3:]) if c.startswith(side)}, **{side + "t": e[0]})
        return Row(key=key[0], channel="unmatched_receipts" if not pay else "unmatched_pays" if not receipt else "matched",
                   **values)

    def _alone(self, key, e):
        return self._row(key, None, e) if e[1] else self._row(key, e, None)

    def _expire(self, key, waiting: deque, us: int):
        while waiting and waiting[0][0] < us - self.bound:
            yield self._alone(key, waiting.popleft())

    def _step(self, key, events, wm):
        waiting = deque(tuple(x) for x in self.waiting.get()) if self.waiting.exists() else deque()
        out = []
        for e in events:
            out += self._expire(key, waiting, e[0])
            if waiting and waiting[0][1] != e[1]:
                o = waiting.popleft()
                out.append(self._row(key, o, e) if e[1] else self._row(key, e, o))
            else:
                waiting.append(e)
        out += self._expire(key, waiting, wm * 1000)
        self.waiting.clear()
        if waiting:
            self.waiting.put(list(waiting))
            self.h.registerTimer(_ms(waiting[0][0] + self.bound) + 1)
        return out

    def on_events(self, key, events, wm):
        return self._step(key, events, wm)

    def on_watermark(self, key, wm):
        return self._step(key, [], wm) if self.waiting.exists() else []


def stream_one_to_one(pays: DataFrame, receipts: DataFrame, key: str = "tx_id", bound="5 seconds",
                      pay_order: str = "seq", receipt_order: str = "pay_channel") -> DataFrame:
    """Streaming twin of ``interval_match(pairing="one")``: the columns of both sides, prefixed, and ``channel``
    (matched, unmatched_pays, unmatched_receipts).  Both inputs are watermarked on ``ts``."""
    def order(df, name):
        c = F.col(name).cast("string")
        return F.lpad(c, 20, "0") if isinstance(df.schema[name].dataType, T.IntegralType) else c

    p, r = ([c for c in d.columns if c not in (key, "ts")] for d in (pays, receipts))
    pay_side = pays.select(key, "ts", F.unix_micros("ts").alias("t"), F.lit(0).alias("side"),
                           order(pays, pay_order).alias("o"), *[F.col(c).alias("pay_" + c) for c in p])
    receipt_side = receipts.select(key, "ts", F.unix_micros("ts").alias("t"), F.lit(1).alias("side"),
                                   order(receipts, receipt_order).alias("o"), *[F.col(c).alias("receipt_" + c) for c in r])
    both = pay_side.unionByName(receipt_side, allowMissingColumns=True)
    names = ["pay_" + c for c in p] + ["receipt_" + c for c in r]
    payload = [both.schema[c] for c in names]
    event = T.StructType([T.StructField("t", T.LongType()), T.StructField("side", T.IntegerType()),
                          T.StructField("o", T.StringType()), *payload])
    proc = OneToOneProcessor(bound, event)
    out = T.StructType([T.StructField("key", both.schema[key].dataType), T.StructField("channel", T.StringType()),
                        *payload, T.StructField("pay_t", T.LongType()), T.StructField("receipt_t", T.LongType())])
    d = both.groupBy(key).transformWithState(proc, out, "Append", "EventTime")
    return d.select(F.col("key").alias(key), "channel", *names, F.timestamp_micros("pay_t").alias("pay_ts"),
                    F.timestamp_micros("receipt_t").alias("receipt_ts"))
