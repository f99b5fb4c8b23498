"""Streaming twins of the registered jobs, wired end to end.

Each job takes the raw (not yet watermarked) streams it needs by name -
``user_behavior``, ``access_log``, ``marketing``, ``ad_click``, ``login``,
``order_events``, ``receipts``: streaming DataFrames with the ``fx_*`` /
parser columns - and returns the streaming result, to be started in append
mode.  Watermarks follow the surveyed jobs (ascending = 0 s; access log 1 min;
login 3 s) and every parameter is the batch job's, so closed windows and keys
equal the batch result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.functions import equals_value, non_empty, not_equals_null_safe
from eventide.plans import jobs as J
from eventide.streaming.eventtime import with_event_time, wm_safe_filter
from eventide.streaming.late_windows import stream_final_counts, stream_windows_with_late
from eventide.streaming.processors import (stream_cap_per_key, stream_consecutive_run, stream_fail_bursts,
                                           stream_followed_by, stream_order_payment_status)
from eventide.streaming.running import write_running_unique_visitors
from eventide.streaming.sinks import split_channels
from eventide.streaming.twins import (stream_interval_join, stream_salted_count, stream_sliding_count, stream_top_n,
                                      stream_unique_visitors)

Streams = dict[str, DataFrame]
STREAM_JOBS: dict[str, Callable[[Streams], DataFrame]] = {}

# Watermark delays of the surveyed jobs.
ASCENDING = "0 seconds"
ACCESS_LOG_DELAY = "1 minute"
LOGIN_DELAY = "3 seconds"


#: Jobs with several named outputs: one stateful query whose ``channel`` column names the output of a row.
OUTPUT_JOBS: dict[str, tuple[Callable[[Streams], DataFrame], tuple[str, ...]]] = {}

#: Jobs that finish their micro-batches with batch operators: (streams, out, checkpoint) -> the started query.
SINK_JOBS: dict[str, Callable[..., StreamingQuery]] = {}


def sink_job(fn):
    SINK_JOBS[fn.__name__] = fn
    return fn


def stream_job(fn):
    STREAM_JOBS[fn.__name__] = fn
    return fn


def output_job(*channels: str):
    """Registers a job whose rows carry a ``channel``; start it with ``write_channels``."""
    def register(fn):
        OUTPUT_JOBS[fn.__name__] = (fn, channels)
        return fn
    return register


def _pv(s: Streams) -> DataFrame:
    return wm_safe_filter(with_event_time(s["user_behavior"], delay=ASCENDING), equals_value("behavior", "pv"))


@stream_job
def hot_items(s: Streams) -> DataFrame:
    c = stream_sliding_count(_pv(s), ["item_id"], J.ITEMS["size"], J.ITEMS["slide"], keep_window=True)
    return stream_top_n(c, J.ITEMS["n"], "item_id")


@stream_job
def item_view_counts(s: Streams) -> DataFrame:
    return stream_sliding_count(_pv(s), ["item_id"], J.ITEMS["size"], J.ITEMS["slide"])


def _page_counts(s: Streams, slide=J.PAGES["slide"]) -> DataFrame:
    d = with_event_time(s["access_log"], delay=ACCESS_LOG_DELAY)
    return stream_final_counts(d, "url", J.PAGES["size"], slide, J.PAGES["lateness"], pred=J.page_pred())


@stream_job
def hot_pages(s: Streams) -> DataFrame:
    return stream_top_n(_page_counts(s), J.PAGES["n"], "url")


@stream_job
def page_view_counts(s: Streams) -> DataFrame:
    return _page_counts(s).drop("closes")


@stream_job
def page_view_counts_5s(s: Streams) -> DataFrame:
    return _page_counts(s, J.PAGES_SLIDE).drop("closes")


@output_job("fired", "late")
def page_windows(s: Streams) -> DataFrame:
    """Every firing of the page windows, first and repeated, and the late rows, from one stateful query."""
    d = with_event_time(s["access_log"], delay=ACCESS_LOG_DELAY)
    return stream_windows_with_late(d, "url", J.PAGES["size"], J.PAGES["slide"], J.PAGES["lateness"], pred=J.page_pred())


@stream_job
def late_page_events(s: Streams) -> DataFrame:
    return split_channels(page_windows(s), ["late"])["late"].drop("window_end", "added")


@stream_job
def page_views_hourly(s: Streams) -> DataFrame:
    return stream_sliding_count(_pv(s), [], J.HOURLY)


@stream_job
def page_views_salted(s: Streams) -> DataFrame:
    return stream_salted_count(_pv(s), J.HOURLY)


@stream_job
def unique_visitors_hourly(s: Streams) -> DataFrame:
    return stream_unique_visitors(_pv(s), J.HOURLY)


@stream_job
def unique_visitors_bitmap(s: Streams) -> DataFrame:
    return stream_unique_visitors(_pv(s), J.HOURLY, cap=1 << 29)


@sink_job
def running_unique_visitors(s: Streams, out: str, checkpoint: str | None = None) -> StreamingQuery:
    return write_running_unique_visitors(_pv(s), "running_unique_visitors", out, J.HOURLY, checkpoint=checkpoint)


def _marketing(s: Streams) -> DataFrame:
    d = with_event_time(s["marketing"], delay=ASCENDING)
    return wm_safe_filter(d, not_equals_null_safe("behavior", "UNINSTALL"))


@stream_job
def marketing_by_channel(s: Streams) -> DataFrame:
    return stream_sliding_count(_marketing(s), ["channel", "behavior"], **J.MARKETING)


@stream_job
def marketing_total(s: Streams) -> DataFrame:
    c = stream_sliding_count(_marketing(s), [], **J.MARKETING)
    return c.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "window_end", "cnt")


@stream_job
def marketing_by_channel_5s(s: Streams) -> DataFrame:
    """The surveyed windows, one hour every 5 seconds: a row costs one pane, not 720 windows."""
    return stream_final_counts(_marketing(s), ["channel", "behavior"], lateness="0 seconds",
                               **J.MARKETING_DEFAULT).drop("closes")


@stream_job
def marketing_total_5s(s: Streams) -> DataFrame:
    c = stream_final_counts(_marketing(s), [], lateness="0 seconds", **J.MARKETING_DEFAULT)
    return c.select(F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "window_end", "cnt")


@stream_job
def ads_by_province(s: Streams) -> DataFrame:
    d = with_event_time(s["ad_click"], delay=ASCENDING)
    return stream_sliding_count(d, ["province"], J.ADS["size"], J.ADS["slide"])


def _capped(s: Streams) -> DataFrame:
    d = with_event_time(s["ad_click"], delay=ASCENDING)
    return stream_cap_per_key(d, J.ADS["cap"], J.ADS["day_offset_hours"])


@output_job("main", "blacklist")
def ad_clicks(s: Streams) -> DataFrame:
    """Clicks within the cap and the warnings, from one stateful query."""
    return _capped(s)


@stream_job
def ad_clicks_capped(s: Streams) -> DataFrame:
    return split_channels(_capped(s), ["main"])["main"].drop("day", "msg")


@stream_job
def ad_blacklist(s: Streams) -> DataFrame:
    b = split_channels(_capped(s), ["blacklist"])["blacklist"]
    return b.select("user_id", "ad_id", "day", F.col("ts").alias("warn_ts"), "msg")


def _login(s: Streams) -> DataFrame:
    return with_event_time(s["login"], delay=LOGIN_DELAY)


@stream_job
def login_fail_pairs(s: Streams) -> DataFrame:
    return stream_consecutive_run(_login(s), 2, J.LOGIN_PAIR_WINDOW, inclusive=True)


@stream_job
def login_fail_pairs_strict(s: Streams) -> DataFrame:
    return stream_consecutive_run(_login(s), 2, J.LOGIN_PAIR_WINDOW, inclusive=False)


@stream_job
def login_fail_runs(s: Streams) -> DataFrame:
    return stream_consecutive_run(_login(s), J.LOGIN_RUN_N)


@stream_job
def login_fail_runs_default(s: Streams) -> DataFrame:
    return stream_consecutive_run(_login(s), J.LOGIN_RUN_DEFAULT_N)


@stream_job
def login_fail_bursts(s: Streams) -> DataFrame:
    return stream_fail_bursts(_login(s), **J.LOGIN_BURST)


def _orders(s: Streams) -> DataFrame:
    return with_event_time(s["order_events"], delay=ASCENDING)


@stream_job
def order_paid(s: Streams) -> DataFrame:
    r = stream_followed_by(_orders(s), J.ORDER_TIMEOUT)
    return r.filter(F.col("result") == "payed").select("order_id", "create_ts", F.col("end_ts").alias("pay_ts"),
                                                        "result")


@stream_job
def order_timeouts(s: Streams) -> DataFrame:
    r = stream_followed_by(_orders(s), J.ORDER_TIMEOUT)
    return r.filter(F.col("result") == "timeout").select("order_id", "create_ts",
                                                         F.col("end_ts").alias("timeout_ts"), "result")


@output_job("main", "side")
def order_payments(s: Streams) -> DataFrame:
    """Paid orders and the side output of timeouts, late and orphaned pays, from one stateful query."""
    return stream_order_payment_status(_orders(s), J.ORDER_TIMEOUT)


@stream_job
def order_payment_status(s: Streams) -> DataFrame:
    return stream_order_payment_status(_orders(s), J.ORDER_TIMEOUT)


def _matched(s: Streams) -> DataFrame:
    orders = with_event_time(s["order_events"], delay=ASCENDING)  # creates advance the watermark too
    pays = wm_safe_filter(orders, non_empty("tx_id")).select("tx_id", "order_id", "seq", "ts")
    recs = with_event_time(s["receipts"], delay=ASCENDING)
    return stream_interval_join(pays, recs, "tx_id", J.MATCH_BOUND)


@output_job("matched", "unmatched_pays", "unmatched_receipts")
def pay_receipt(s: Streams) -> DataFrame:
    """Matched and both kinds of unmatched rows, from one stateful query."""
    return _matched(s)


@stream_job
def pay_receipt_match(s: Streams) -> DataFrame:
    return split_channels(_matched(s), ["matched"])["matched"]


@stream_job
def unmatched_pays(s: Streams) -> DataFrame:
    return split_channels(_matched(s), ["unmatched_pays"])["unmatched_pays"].select(
        "tx_id", "pay_order_id", "pay_seq", "pay_ts")


@stream_job
def unmatched_receipts(s: Streams) -> DataFrame:
    return split_channels(_matched(s), ["unmatched_receipts"])["unmatched_receipts"].select(
        "tx_id", "receipt_pay_channel", "receipt_ts")
