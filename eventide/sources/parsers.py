"""Positional comma-separated line parsers (one per record shape).

Every parser takes a DataFrame with a string column ``value`` (what
``spark.read.text`` / ``readStream.text`` / a Kafka value cast produces) and
returns ``Parsed(rows, rejects)``: well-formed rows with typed columns, and
the malformed lines with a reason, instead of failing the job.

Fields are split with ``split(value, ',')`` plus ``try_cast``; ``from_csv``
is not used because it turns an empty field into null, while an empty
``tx_id`` must stay ``''``.  Extra trailing fields are ignored, as a
positional reader would.  Epoch-second fields become ``timestamp_ntz``
(UTC wall clock) so results do not depend on the session time zone;
``with_event_time`` turns them into instants for streaming watermarks.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.timeutil import epoch_seconds_to_ntz

# Fixed value: the access-log time, dd/MM/yyyy:HH:mm:ss (minutes where the survey notes the wrong letter).
ACCESS_LOG_TIME = r"^\d{2}/\d{2}/\d{4}:\d{2}:\d{2}:\d{2}$"


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def read_lines(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """A text file (or folder) as lines in column ``value``."""
    reader = spark.readStream if stream else spark.read
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.text(path)


def _field(i: int) -> Column:
    return F.get(F.col("_f"), i)


def _parse(lines: DataFrame, n_fields: int, cols: dict[str, Column]) -> Parsed:
    """Other input columns (e.g. an arrival ``seq``) pass through to the parsed rows."""
    keep = [c for c in lines.columns if c != "value"]
    split = lines.withColumn("_f", F.split(F.col("value"), ","))
    typed = split.select("value", *keep, F.size("_f").alias("_n"), *[c.alias(n) for n, c in cols.items()])
    ok = F.col("_n") >= n_fields
    for n in cols:
        ok = ok & F.col(n).isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    reason = F.when(F.col("_n") < n_fields, F.lit(f"expected {n_fields} fields"))
    for n in cols:
        reason = reason.when(F.col(n).isNull(), F.lit(f"bad {n}"))
    rows = typed.filter(ok).select(*keep, *cols.keys())
    rejects = typed.filter(~ok).select("value", reason.alias("reason"))
    return Parsed(rows, rejects)


def _long(i):
    return _field(i).try_cast("bigint")


# Seconds a timestamp can hold: years 1 to 9999.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def _secs(i):
    """Null (a reject) for what is no number or outside the calendar, e.g. milliseconds by mistake."""
    s = _long(i)
    return epoch_seconds_to_ntz(F.when(s.between(_FIRST_SECOND, _LAST_SECOND), s))


def _log_time(i):
    """dd/MM/yyyy:HH:mm:ss as written, without a detour over a zone (null for anything else)."""
    part = [F.try_element_at(F.split(_field(i), "[/:]"), F.lit(k)).try_cast("int") for k in (3, 2, 1, 4, 5, 6)]
    return F.when(_field(i).rlike(ACCESS_LOG_TIME), F.try_make_timestamp_ntz(*part))


def parse_user_behavior(lines: DataFrame) -> Parsed:
    """userId,itemId,categoryId,behavior,timestamp(s)."""
    return _parse(lines, 5, {"user_id": _long(0), "item_id": _long(1),
                             "category_id": _field(2).try_cast("int"), "behavior": _field(3),
                             "ts": _secs(4)})


def parse_access_log(lines: DataFrame) -> Parsed:
    """Ip,userId,-,dd/MM/yyyy:HH:mm:ss,-,method,url (fields 2 and 4 ignored)."""
    return _parse(lines, 7, {"ip": _field(0), "user_id": _field(1), "ts": _log_time(3),
                             "method": _field(5), "url": _field(6)})


def parse_ad_click(lines: DataFrame) -> Parsed:
    """userId,adId,province,city,timestamp(s)."""
    return _parse(lines, 5, {"user_id": _long(0), "ad_id": _long(1), "province": _field(2),
                             "city": _field(3), "ts": _secs(4)})


def parse_login(lines: DataFrame) -> Parsed:
    """userId,ip,state,timestamp(s)."""
    return _parse(lines, 4, {"user_id": _long(0), "ip": _field(1), "login_state": _field(2),
                             "ts": _secs(3)})


def parse_order(lines: DataFrame) -> Parsed:
    """orderId,eventType,txId,timestamp(s); an empty txId stays ''."""
    return _parse(lines, 4, {"order_id": _long(0), "event_type": _field(1), "tx_id": _field(2),
                             "ts": _secs(3)})


def parse_receipt(lines: DataFrame) -> Parsed:
    """txId,payChannel,timestamp(s)."""
    return _parse(lines, 3, {"tx_id": _field(0), "pay_channel": _field(1), "ts": _secs(2)})
