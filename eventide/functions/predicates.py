"""Row predicates (F1-F5) as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.timeutil import col

# Fixed value: URLs ending in these extensions are static assets (case-sensitive,
# whole-suffix match; a query string after the extension keeps the URL).
STATIC_ASSET_PATTERN = r"\.(css|js|png|ico)$"


def equals_value(c, value) -> Column:
    """``value.equals(c)`` semantics - null is false, never null."""
    return F.coalesce(col(c) == F.lit(value), F.lit(False))


def not_equals_null_safe(c, value) -> Column:
    """``!value.equals(c)`` - a null field passes (plain != would drop it)."""
    return ~col(c).eqNullSafe(F.lit(value))


def is_static_asset(url) -> Column:
    return F.coalesce(col(url).rlike(STATIC_ASSET_PATTERN), F.lit(False))


def exclude_static_assets(df: DataFrame, url: str = "url") -> DataFrame:
    """keep URLs that do not end in a static-asset extension ('' is kept)."""
    return df.filter(~is_static_asset(url))


def non_empty(c) -> Column:
    """``!"".equals(c)`` - a null key passes, like the surveyed check."""
    return ~col(c).eqNullSafe(F.lit(""))


def wm_safe_filter(df: DataFrame, pred: Column, ts: str = "ts") -> DataFrame:
    """Filter a watermarked stream without moving the filter under the watermark.

    Catalyst pushes a deterministic filter that does not mention the event-time
    column below ``withWatermark``; filtered rows would then stop advancing the
    watermark.  Wrapping the predicate as one conjunct that references ``ts``
    keeps it above.  On batch DataFrames this is an ordinary filter.
    """
    return df.filter(F.when(F.col(ts).isNull(), F.lit(False)).otherwise(F.coalesce(pred, F.lit(False))))


def filter_behavior(df: DataFrame, value: str = "pv", column: str = "behavior") -> DataFrame:
    """F1 as a DataFrame operator: keep rows whose behaviour equals ``value``."""
    return df.filter(equals_value(column, value))


def exclude_behavior(df: DataFrame, value: str = "UNINSTALL", column: str = "behavior") -> DataFrame:
    """F2 as a DataFrame operator: drop rows whose behaviour equals ``value``; null behaviour is kept."""
    return df.filter(not_equals_null_safe(column, value))
