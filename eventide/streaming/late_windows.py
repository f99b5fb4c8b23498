"""Sliding counts that own their windows and their late rows (T4, A10, T9, A2 at small slides).

Spark drops rows behind the previous micro-batch's watermark before a stateful operator sees them, so a late test
behind that filter loses some late rows and disagrees with the counts about others.  Here one processor does both:
it is fed the event time as plain epoch microseconds, which Spark's filter does not know, and reads the watermark
itself.  Every row is counted in its windows that are still open, or, if none is, goes out as late; never both.

State per (key, salt): counts per slide-wide pane, so a row costs one pane whatever size / slide is, and one timer at
the next window end.  A window fires when the watermark passes its end; rows that come after that, while its allowed
lateness lasts, fire it again.  Each firing carries the count *added* since the last one, so the latest count of a
window is the sum of its firings (``latest_counts``), whatever the number of salts and micro-batches.

Keys are salted, so a hot key is spread over ``salts`` groups; panes of a group number at most
(size + lateness + delay) / slide, plus those ahead of the watermark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventide.functions.predicates import wm_safe_filter
from eventide.timeutil import seconds

_L = T.LongType()
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _long(name):
    return T.StructType([T.StructField(name, _L)])


class LateWindowProcessor(StatefulProcessor):
    """Firings (key, end, added) and, with ``passes``, late rows.  All times are epoch microseconds."""

    def __init__(self, keys: list[str], size, slide, lateness, passes: tuple[str, ...] = ()):
        self.keys, self.passes = keys, passes
        self.size, self.slide, self.lateness = (int(round(seconds(x) * 1_000_000)) for x in (size, slide, lateness))

    def init(self, handle):
        self.handle = handle
        self.panes = handle.getMapState("panes", _long("pane"), _long("n"))
        self.fired = handle.getValueState("fired", T.StructType([T.StructField("wm", _L), T.StructField("timer", _L)]))

    def _ends(self, pane: int):
        """Ends of the windows that hold a pane."""
        return range(pane + self.slide, pane + self.size + 1, self.slide)

    def _is_over(self, end: int, wm: int, lateness: int = 0) -> bool:
        return end - 1000 + lateness <= wm

    def _fire(self, panes: dict, before: int, wm: int) -> dict:
        """Whole counts of the windows whose end the watermark has passed since ``before``."""
        added = {}
        for pane, n in panes.items():
            for end in self._ends(pane):
                if not self._is_over(end, before) and self._is_over(end, wm):
                    added[end] = added.get(end, 0) + n
        return added

    def _advance(self, rows, wm: int) -> tuple[list, list]:
        """(window end, rows added since its last firing) of what fires now, and the late rows."""
        before, timer = tuple(self.fired.get()) if self.fired.exists() else (-(1 << 62), None)
        panes = {k[0]: v[0] for k, v in self.panes.iterator()}
        added = self._fire(panes, before, wm) if wm > before else {}
        late, new = [], {}
        for r in rows:
            pane = r.t - r.t % self.slide
            if self._is_over(pane + self.size, wm, self.lateness):
                if self.passes:
                    late.append({c: r[c] for c in self.passes})
            else:
                new[pane] = new.get(pane, 0) + 1
        for pane, n in new.items():
            for end in self._ends(pane):
                if self._is_over(end, wm) and not self._is_over(end, wm, self.lateness):
                    added[end] = added.get(end, 0) + n
            panes[pane] = panes.get(pane, 0) + n
        pending = None
        for pane, n in panes.items():
            if self._is_over(pane + self.size, wm):  # all its windows have fired; later rows add to them directly
                if self.panes.containsKey((pane,)):
                    self.panes.removeKey((pane,))
                continue
            if pane in new:
                self.panes.updateValue((pane,), (n,))
            end = next(e for e in self._ends(pane) if not self._is_over(e, wm))
            pending = end if pending is None else min(pending, end)
        due = None if pending is None else -(-(pending - 1000) // 1000)
        if due is None:
            self.fired.clear()
        elif (wm, due) != (before, timer):
            self.fired.update((wm, due))
        if due != timer:
            if timer is not None and timer > wm // 1000:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        return sorted(added.items()), late

    def _rows(self, key, fired: list, late: list, wm: int):
        for values in late:
            yield Row(channel="late", window_end=None, added=None, watermark=wm, **values)
        nothing = dict.fromkeys(self.passes)
        for end, n in fired:
            yield Row(channel="fired", window_end=end, added=n, watermark=wm, **{**nothing, **dict(zip(self.keys, key))})

    def handleInputRows(self, key, rows, timerValues):
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        return self._rows(key, *self._advance(rows, wm), wm)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self.handleInputRows(key, [], timerValues)

    def close(self):
        pass


class FiringProcessor(LateWindowProcessor):
    """Firings alone, with the time at which their window closes for good as event time, so that Spark's own
    aggregates can follow."""

    def _rows(self, key, fired: list, late: list, wm: int):
        for end, n in fired:
            closes = _EPOCH + dt.timedelta(microseconds=end + self.lateness)
            yield Row(**dict(zip(self.keys, key)), window_end=end, added=n, closes=closes)


def _as_list(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _salted(df: DataFrame, keys: list[str], columns: list[str], salt_of: str, salts: int, ts: str, pred: Column | None):
    """Copy of a watermarked stream with plain times; rows failing ``pred`` still move the watermark."""
    d = df.withColumn("t", F.unix_micros(ts))
    if pred is not None:
        d = wm_safe_filter(d, pred)
    salt = F.pmod(F.xxhash64(salt_of), F.lit(salts)).alias("_salt")
    return d.select(*[c for c in columns if c != ts], "t", salt).groupBy(*keys, "_salt")


def stream_windows_with_late(df: DataFrame, keys: str | list[str], size, slide, lateness="1 minute", ts: str = "ts",
                             salt_of: str = "seq", salts: int = 16, pred: Column | None = None) -> DataFrame:
    """One stateful query, two named outputs: ``fired`` (key, window_end, added) and ``late`` (the input's columns),
    both with the ``watermark`` they were judged by.  ``df`` is watermarked with the out-of-orderness delay alone."""
    keys, columns = _as_list(keys), df.columns
    if taken := {"channel", "window_end", "added", "watermark"} & set(columns):
        raise ValueError(f"columns of the input named like those of the outputs: {sorted(taken)}")
    plain = [c for c in columns if c != ts]
    proc = LateWindowProcessor(keys, size, slide, lateness, (*plain, "t"))
    schema = T.StructType([T.StructField("channel", T.StringType()), T.StructField("window_end", _L),
                           T.StructField("added", _L), T.StructField("watermark", _L)]
                          + [T.StructField(c, df.schema[c].dataType) for c in plain] + [T.StructField("t", _L)])
    out = _salted(df, keys, columns, salt_of, salts, ts, pred).transformWithState(proc, schema, "Append", "EventTime")
    return out.select("channel", *[(F.timestamp_micros("t") if c == ts else F.col(c)).alias(c) for c in columns],
                      F.timestamp_micros("window_end").alias("window_end"), "added",
                      F.timestamp_micros("watermark").alias("watermark"))


def stream_final_counts(df: DataFrame, keys: str | list[str], size, slide, lateness="1 minute", ts: str = "ts",
                        salt_of: str = "seq", salts: int = 16, pred: Column | None = None) -> DataFrame:
    """The same windows, each once, when its allowed lateness is over: (closes, keys, window_end, cnt), where
    ``closes`` is the event time of Spark's operators that follow.  No keys: totals."""
    keys = _as_list(keys)
    proc = FiringProcessor(keys, size, slide, lateness)
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("window_end", _L), T.StructField("added", _L),
                           T.StructField("closes", T.TimestampType())])
    fired = (_salted(df, keys, df.columns, salt_of, salts, ts, pred)
             .transformWithState(proc, schema, "Append", "EventTime", eventTimeColumnName="closes"))
    counts = fired.groupBy("closes", *keys, "window_end").agg(F.sum("added").alias("cnt"))
    return counts.select("closes", *keys, F.timestamp_micros("window_end").alias("window_end"), "cnt")


def latest_counts(fired: DataFrame, keys: str | list[str]) -> DataFrame:
    """Newest count of every window from the log of its firings (batch): (keys, window_end, cnt)."""
    return fired.groupBy(*_as_list(keys), "window_end").agg(F.sum("added").alias("cnt"))
