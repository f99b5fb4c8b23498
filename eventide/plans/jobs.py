"""One job per query name: (spark, sf_dir) -> DataFrame.

Jobs read the driver tables through the ``fx_*`` fixture views and run the
surveyed pipelines end to end on whole tables.  Parameters follow the
fixture table (FIXTURES.md section 4); the operator defaults are the surveyed
constants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions import (bitmap_offset, equals_value, exclude_static_assets, format_ranking,
                                non_empty, not_equals_null_safe)
from eventide.functions.formatting import ITEM_LABELS, PAGE_LABELS
from eventide.functions.predicates import is_static_asset
from eventide import operators as ops
from eventide.operators import (cap_per_key, consecutive_pairs, consecutive_run, fail_bursts, followed_by,
                                interval_match, rollup_profile, salted_count, sliding_count,
                                sliding_count_with_lateness, split_late, top_n_per_window, tumbling_count,
                                unique_visitors)
from eventide.sources import Fixtures, parse_access_log, parse_ad_click, parse_login, parse_order, \
    parse_receipt, parse_user_behavior
from eventide.timeutil import ntz_to_epoch_seconds

# Query parameters on the fixtures (FIXTURES.md section 4).
ITEMS = dict(size="1 hour", slide="5 minutes", n=5)
PAGES_SLIDE = "5 seconds"
PAGES = dict(size="10 minutes", slide="1 minute", n=3, delay="1 minute", lateness="1 minute")
MARKETING = dict(size="1 hour", slide="5 minutes")
MARKETING_DEFAULT = dict(size="1 hour", slide="5 seconds")
ADS = dict(size="1 hour", slide="5 minutes", cap=2, day_offset_hours=8)
HOURLY = "1 hour"
SMALL_CAP = 1 << 6
LOGIN_PAIR_WINDOW = "6 hours"
LOGIN_BURST = dict(window="24 hours", min_fails=2)
LOGIN_RUN_N = 3
LOGIN_RUN_DEFAULT_N = 8  # the surveyed value
ORDER_TIMEOUT = "900 seconds"
MATCH_BOUND = "5 seconds"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn=None, *, name: str | None = None):
    def reg(f):
        QUERIES[name or f.__name__] = f
        return f
    return reg(fn) if fn is not None else reg


def _fx(spark, sf_dir) -> Fixtures:
    return Fixtures(spark, sf_dir)


# ---- hot items (A1, A9, K0a, P3) -------------------------------------------------------------

def _pv(fx: Fixtures) -> DataFrame:
    return fx.user_behavior.filter(equals_value("behavior", "pv"))


@query
def item_view_counts(spark, sf_dir, strategy="auto"):
    return sliding_count(_pv(_fx(spark, sf_dir)), ["item_id"], ITEMS["size"], ITEMS["slide"], strategy=strategy)


@query
def item_view_counts_direct(spark, sf_dir):
    return item_view_counts(spark, sf_dir, strategy="direct")


@query
def sliding_pane_equals_direct(spark, sf_dir):
    """A9 check on the whole table: per item, the windows and views of all three strategies, and whether every window
    has the same count in each."""
    pv = _pv(_fx(spark, sf_dir))
    counts = [sliding_count(pv, ["item_id"], ITEMS["size"], ITEMS["slide"], strategy=s, out=s)
              for s in ("direct", "pane", "delta")]
    all_ = counts[0].join(counts[1], ["item_id", "window_end"], "full").join(counts[2], ["item_id", "window_end"], "full")
    same = F.col("direct").eqNullSafe(F.col("pane")) & F.col("direct").eqNullSafe(F.col("delta"))
    return all_.groupBy("item_id").agg(F.count("pane").alias("n_windows"), F.sum("pane").alias("sum_pane"),
                                       F.sum("delta").alias("sum_delta"), F.min(same).alias("same"))


@query
def item_view_counts_delta(spark, sf_dir):
    return item_view_counts(spark, sf_dir, strategy="delta")


@query
def marketing_total_profile_pane(spark, sf_dir):
    c = _total(sliding_count(_marketing(_fx(spark, sf_dir)), [], **MARKETING_DEFAULT, strategy="pane"))
    return rollup_profile(c, ["channel", "behavior"])


@query
def hot_items(spark, sf_dir):
    return top_n_per_window(item_view_counts(spark, sf_dir), ITEMS["n"], "item_id")


@query(name="format_ranking")
def format_ranking_items(spark, sf_dir):
    return format_ranking(hot_items(spark, sf_dir), "item_id", ITEM_LABELS)


# ---- hot pages (F3, F4, A2, K0b, T4) ----------------------------------------------------------

def _page_rows(fx: Fixtures) -> DataFrame:
    return exclude_static_assets(fx.access_log.filter(equals_value("method", "GET")))


@query
def page_view_counts(spark, sf_dir):
    return sliding_count(_page_rows(_fx(spark, sf_dir)), ["url"], PAGES["size"], PAGES["slide"])


@query
def hot_pages(spark, sf_dir):
    return top_n_per_window(page_view_counts(spark, sf_dir), PAGES["n"], "url")


@query
def format_ranking_pages(spark, sf_dir):
    return format_ranking(hot_pages(spark, sf_dir), "url", PAGE_LABELS)


# arrivals are epoch microseconds: one scan bucket is an hour
ARRIVALS = dict(seq="arrival", tie=("seq",), rows_per_bucket=3_600_000_000)


def page_pred() -> Column:
    return equals_value("method", "GET") & ~is_static_asset("url")


@query
def late_page_events(spark, sf_dir):
    return split_late(_fx(spark, sf_dir).access_log_arrivals, PAGES["size"], PAGES["slide"], PAGES["delay"],
                      PAGES["lateness"], pred=page_pred(), **ARRIVALS).late


@query
def page_view_counts_lateness(spark, sf_dir):
    return sliding_count_with_lateness(_fx(spark, sf_dir).access_log_arrivals, ["url"], PAGES["size"], PAGES["slide"],
                                       PAGES["delay"], PAGES["lateness"], pred=page_pred(), **ARRIVALS)


@query
def hot_pages_lateness(spark, sf_dir):
    return top_n_per_window(page_view_counts_lateness(spark, sf_dir), PAGES["n"], "url")


@query
def page_view_counts_5s(spark, sf_dir):
    """The surveyed windows: 10 minutes every 5 seconds."""
    return sliding_count(_page_rows(_fx(spark, sf_dir)), ["url"], PAGES["size"], PAGES_SLIDE)


@query(name="exclude_static_assets")
def exclude_static_assets_rows(spark, sf_dir):
    return exclude_static_assets(_fx(spark, sf_dir).access_log)


# ---- page views / unique visitors (A3, A5, D1-D5) ---------------------------------------------

@query
def page_views_hourly(spark, sf_dir):
    return tumbling_count(_pv(_fx(spark, sf_dir)), [], HOURLY)


@query
def page_views_salted(spark, sf_dir):
    return salted_count(_pv(_fx(spark, sf_dir)), [], HOURLY)


@query
def unique_visitors_hourly(spark, sf_dir):
    return unique_visitors(_pv(_fx(spark, sf_dir)), HOURLY)


@query
def unique_visitors_bitmap(spark, sf_dir):
    return ops.unique_visitors_bitmap(_pv(_fx(spark, sf_dir)), HOURLY)


@query
def unique_visitors_bitmap_small(spark, sf_dir):
    return ops.unique_visitors_bitmap(_pv(_fx(spark, sf_dir)), HOURLY, cap=SMALL_CAP)


@query
def bitmap_offsets(spark, sf_dir):
    users = _fx(spark, sf_dir).user_behavior.select("user_id").distinct()
    return users.select("user_id", bitmap_offset("user_id").alias("bit_offset"))


@query
def running_unique_visitors(spark, sf_dir):
    return ops.running_unique_visitors(_pv(_fx(spark, sf_dir)), HOURLY)


@query
def unique_visitors_hll(spark, sf_dir):
    return ops.unique_visitors_hll(_pv(_fx(spark, sf_dir)), HOURLY)


#: Five standard errors of a sketch of 2^12 registers.
HLL_TOLERANCE = 0.08


@query
def unique_visitors_hll_tolerance(spark, sf_dir):
    """The sketch beside the exact count of every day, and whether it is close enough."""
    pv = _pv(_fx(spark, sf_dir))
    exact = unique_visitors(pv, "1 day")
    sketch = ops.unique_visitors_hll(pv, "1 day", out="sketch")
    close = F.abs(F.col("sketch") - F.col("uv")) <= F.greatest(F.lit(1.0), F.lit(HLL_TOLERANCE) * F.col("uv"))
    return exact.join(sketch, "window_end").select("window_end", "uv", close.alias("within_tolerance"))


# ---- marketing (F2, A4, A6) ---------------------------------------------------------------------

def _marketing(fx: Fixtures) -> DataFrame:
    return fx.marketing.filter(not_equals_null_safe("behavior", "UNINSTALL"))


def _total(df: DataFrame) -> DataFrame:
    return df.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"), *df.columns)


@query
def exclude_behavior(spark, sf_dir):
    return _marketing(_fx(spark, sf_dir))


@query
def marketing_by_channel(spark, sf_dir):
    return sliding_count(_marketing(_fx(spark, sf_dir)), ["channel", "behavior"], **MARKETING)


@query
def marketing_total(spark, sf_dir):
    return _total(sliding_count(_marketing(_fx(spark, sf_dir)), [], **MARKETING))


@query
def marketing_by_channel_profile(spark, sf_dir):
    c = sliding_count(_marketing(_fx(spark, sf_dir)), ["channel", "behavior"], **MARKETING_DEFAULT)
    return rollup_profile(c, ["channel", "behavior"])


@query
def marketing_total_profile(spark, sf_dir):
    c = _total(sliding_count(_marketing(_fx(spark, sf_dir)), [], **MARKETING_DEFAULT))
    return rollup_profile(c, ["channel", "behavior"])


# ---- ads (A7, K1-K3) ----------------------------------------------------------------------------

def _capped(spark, sf_dir):
    return cap_per_key(_fx(spark, sf_dir).ad_click, ["user_id", "ad_id"], cap=ADS["cap"],
                       day_offset_hours=ADS["day_offset_hours"])


@query
def ads_by_province(spark, sf_dir):
    return sliding_count(_fx(spark, sf_dir).ad_click, ["province"], ADS["size"], ADS["slide"])


@query
def ad_clicks_capped(spark, sf_dir):
    return _capped(spark, sf_dir).passed


@query
def ad_blacklist(spark, sf_dir):
    return _capped(spark, sf_dir).warnings


@query
def ads_by_province_capped(spark, sf_dir):
    return sliding_count(_capped(spark, sf_dir).passed, ["province"], ADS["size"], ADS["slide"])


# ---- login failures (C1-C4) ----------------------------------------------------------------------

@query
def login_fail_pairs(spark, sf_dir):
    return consecutive_pairs(_fx(spark, sf_dir).login, LOGIN_PAIR_WINDOW, inclusive=True)


@query
def login_fail_pairs_strict(spark, sf_dir):
    return consecutive_pairs(_fx(spark, sf_dir).login, LOGIN_PAIR_WINDOW, inclusive=False)


@query
def login_fail_bursts(spark, sf_dir):
    return fail_bursts(_fx(spark, sf_dir).login, **LOGIN_BURST)


@query
def login_fail_runs(spark, sf_dir):
    return consecutive_run(_fx(spark, sf_dir).login, LOGIN_RUN_N)


@query
def login_fail_runs_default(spark, sf_dir):
    return consecutive_run(_fx(spark, sf_dir).login, LOGIN_RUN_DEFAULT_N)


# ---- orders (C5-C7) and payment matching (J1-J3) -------------------------------------------------

@query
def order_paid(spark, sf_dir):
    return followed_by(_fx(spark, sf_dir).order_events, ORDER_TIMEOUT).matched


@query
def order_timeouts(spark, sf_dir):
    return followed_by(_fx(spark, sf_dir).order_events, ORDER_TIMEOUT).timeouts


@query
def order_payment_status(spark, sf_dir):
    return ops.order_payment_status(_fx(spark, sf_dir).order_events, ORDER_TIMEOUT)


def _match(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    pays = fx.order_events.filter(non_empty("tx_id")).select("tx_id", "order_id", "seq", "ts")
    return interval_match(pays, fx.receipts, "tx_id", MATCH_BOUND, left_order=["seq"],
                          right_order=["pay_channel"])


MATCH_FIRST = dict(bound="6 hours", groups=997)
MATCH_ONE = dict(bound="10 minutes", groups=97)


def _match_groups(spark, sf_dir, groups: int, bound, pairing: str):
    """Matching on ids that repeat: transactions fall into ``groups`` of the order number."""
    fx = _fx(spark, sf_dir)
    pays = fx.order_events.filter(non_empty("tx_id")).select(
        F.concat(F.lit("g"), F.col("order_id") % groups).alias("tx_id"), "order_id", "seq", "ts")
    number = F.substring("tx_id", 3, 20).cast("bigint")
    receipts = fx.receipts.select(F.concat(F.lit("g"), number % groups).alias("tx_id"), number.alias("order_id"),
                                  "pay_channel", "ts")
    return interval_match(pays, receipts, "tx_id", bound, left_order=["seq"], right_order=["order_id"], pairing=pairing)


@query
def pay_receipt_first(spark, sf_dir):
    return _match_groups(spark, sf_dir, MATCH_FIRST["groups"], MATCH_FIRST["bound"], "first").matched


@query
def pay_receipt_one_to_one(spark, sf_dir):
    return _match_groups(spark, sf_dir, MATCH_ONE["groups"], MATCH_ONE["bound"], "one").matched


@query
def pay_receipt_match(spark, sf_dir):
    return _match(spark, sf_dir).matched


@query
def unmatched_pays(spark, sf_dir):
    return _match(spark, sf_dir).unmatched_left


@query
def unmatched_receipts(spark, sf_dir):
    return _match(spark, sf_dir).unmatched_right


# ---- parsers (S5-S8): raw lines rendered from the fixture views, parsed back -------------------

def _epoch_s(c):
    return ntz_to_epoch_seconds(c).cast("string")


def _lines(df: DataFrame, *cols) -> DataFrame:
    return df.select(F.concat_ws(",", *cols).alias("value"))


@query(name="parse_user_behavior")
def parse_user_behavior_rows(spark, sf_dir):
    ub = _fx(spark, sf_dir).user_behavior
    return parse_user_behavior(_lines(ub, "user_id", "item_id", "category_id", "behavior", _epoch_s("ts"))).rows


@query(name="parse_access_log")
def parse_access_log_rows(spark, sf_dir):
    a = _fx(spark, sf_dir).access_log
    lines = _lines(a, "ip", "user_id", F.lit("-"), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("-"),
                   "method", "url")
    return parse_access_log(lines).rows


@query(name="parse_ad_click")
def parse_ad_click_rows(spark, sf_dir):
    a = _fx(spark, sf_dir).ad_click
    return parse_ad_click(_lines(a, "user_id", "ad_id", "province", "city", _epoch_s("ts"))).rows


@query(name="parse_login")
def parse_login_rows(spark, sf_dir):
    a = _fx(spark, sf_dir).login
    return parse_login(_lines(a, "user_id", "ip", "login_state", _epoch_s("ts"))).rows


@query(name="parse_order")
def parse_order_rows(spark, sf_dir):
    a = _fx(spark, sf_dir).order_events
    return parse_order(_lines(a, "order_id", "event_type", "tx_id", _epoch_s("ts"))).rows


@query(name="parse_receipt")
def parse_receipt_rows(spark, sf_dir):
    a = _fx(spark, sf_dir).receipts
    return parse_receipt(_lines(a, "tx_id", "pay_channel", _epoch_s("ts"))).rows
