"""Small time helpers shared by operators.

Event time is one column ``ts``.  Operators accept ``timestamp`` and
``timestamp_ntz`` alike; the conversions here do not depend on the session
time zone (NTZ values are read as UTC wall-clock time).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "ms": 0.001, "millisecond": 0.001, "milliseconds": 0.001,
    "s": 1, "sec": 1, "second": 1, "seconds": 1,
    "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
}

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def seconds(d) -> float:
    """'1 hour' / '5 seconds' / 300 -> seconds."""
    if isinstance(d, (int, float)):
        return d
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"bad duration {d!r}")
    return float(m.group(1)) * _UNITS[m.group(2).lower()]


def interval_str(d) -> str:
    s = seconds(d)
    if s == int(s):
        return f"{int(s)} seconds"
    return f"{int(round(s * 1000))} milliseconds"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plus_seconds(ts, secs) -> Column:
    """ts + secs (int literal or integer column); keeps the timestamp type."""
    if isinstance(secs, (int, float)):
        return col(ts) + F.expr(f"INTERVAL {interval_str(secs)}")
    return col(ts) + F.make_dt_interval(secs=col(secs).cast("decimal(18,6)"))


# NTZ <-> epoch uses plain interval arithmetic: ``timestampdiff`` on timestamp_ntz
# applies the session zone (an hour off inside a DST gap), interval math does not.

def epoch_seconds_to_ntz(c) -> Column:
    return F.expr(EPOCH_NTZ) + F.make_dt_interval(secs=col(c).cast("decimal(18,6)"))


def epoch_millis_to_ntz(c) -> Column:
    return F.expr(EPOCH_NTZ) + F.make_dt_interval(secs=(col(c).cast("decimal(24,6)") / 1000).cast("decimal(18,6)"))


def epoch_micros_to_ntz(c) -> Column:
    return F.expr(EPOCH_NTZ) + F.make_dt_interval(secs=(col(c).cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)"))


def _since_epoch(c) -> Column:
    return (col(c) - F.expr(EPOCH_NTZ)).cast("interval second")


def ntz_to_epoch_seconds(c) -> Column:
    """Whole seconds since the epoch of a timestamp_ntz (UTC wall clock), floor for instants after 1970."""
    return _since_epoch(c).cast("bigint")


def ntz_to_epoch_micros(c) -> Column:
    return (_since_epoch(c).cast("decimal(24,6)") * 1_000_000).cast("bigint")


def ntz_to_instant(c) -> Column:
    """timestamp_ntz (UTC wall clock) -> timestamp (instant)."""
    return F.timestamp_micros(ntz_to_epoch_micros(c))


def instant_to_ntz(c) -> Column:
    secs = (F.unix_micros(col(c)).cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)")
    return F.expr(EPOCH_NTZ) + F.make_dt_interval(secs=secs)


def epoch_micros(c, dtype: str) -> Column:
    """Epoch microseconds of a timestamp / timestamp_ntz column."""
    return ntz_to_epoch_micros(c) if dtype == "timestamp_ntz" else F.unix_micros(col(c))


def ts_type(df, name: str) -> str:
    return df.schema[name].dataType.simpleString()
