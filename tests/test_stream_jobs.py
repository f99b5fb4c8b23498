"""Every registered streaming job equals its batch job on closed windows / keys (sf0.001 replay)."""

import datetime as dt
import tempfile

import pytest

from conftest import SF_SMALL, ts
from eventide.plans import QUERIES
from eventide.sources import Fixtures
from eventide.streaming.harness import read_ordered_files, write_ordered_files
from eventide.streaming.jobs import STREAM_JOBS

# batch: one outcome per order; batch: its input arrives out of order (test_late_windows.py)
# the 5 s windows have no batch query of their own but their profile
OWN_TESTS = {"order_payment_status", "late_page_events", "marketing_by_channel_5s", "marketing_total_5s"}

FAR = ts("2031-01-01 00:00:00")

# one flush row per source: far in the future, passes every filter, never part of a compared result
FLUSH = {
    "user_behavior": {"seq": 10 ** 9, "user_id": 1, "item_id": 1, "category_id": 1, "behavior": "pv", "ts": FAR},
    "access_log": {"seq": 10 ** 9, "ip": "x", "user_id": "0", "ts": FAR, "method": "GET", "url": "/p/flush"},
    "marketing": {"seq": 10 ** 9, "user_id": 0, "behavior": "CLICK", "channel": "wechat", "ts": FAR},
    "ad_click": {"seq": 10 ** 9, "user_id": 10 ** 6, "ad_id": 0, "province": "P", "city": "c", "ts": FAR},
    "login": {"seq": 10 ** 9, "user_id": 10 ** 6, "ip": "x", "login_state": "success", "ts": FAR},
    "order_events": {"seq": 10 ** 12, "order_id": 10 ** 9, "event_type": "pay", "tx_id": "flush", "ts": FAR},
    "receipts": {"tx_id": "flush", "pay_channel": "x", "ts": FAR},
}
ORDER_COL = {"order_events": "ts", "receipts": "ts"}
SOURCES = {"user_behavior": "user_behavior", "access_log": "access_log", "marketing": "marketing",
           "ad_click": "ad_click", "login": "login", "order_events": "order_events", "receipts": "receipts"}


@pytest.fixture(scope="module")
def streams(spark):
    fx = Fixtures(spark, SF_SMALL)
    cache = {}

    def get(name):
        df = getattr(fx, SOURCES[name])
        folder = tempfile.mkdtemp(prefix=f"src-{name}-")
        write_ordered_files(df, folder, 3, ORDER_COL.get(name, "seq"), flush_row=FLUSH[name])
        return read_ordered_files(spark, folder, df.schema)

    class Lazy(dict):
        def __missing__(self, k):
            cache[k] = get(k)
            return cache[k]
    return Lazy()


def closed(rows):
    """Rows on closed windows and keys, with repeats."""
    out = []
    for r in rows:
        vals = tuple(r)
        if all(not isinstance(v, dt.datetime) or v < FAR - dt.timedelta(days=1) for v in vals):
            out.append(vals)
    return sorted(out, key=str)


@pytest.mark.parametrize("name", sorted(set(STREAM_JOBS) - OWN_TESTS))
def test_stream_job_equals_batch(spark, streams, name):
    out = STREAM_JOBS[name](streams)
    qn = "sj_" + name + next(tempfile._get_candidate_names())
    q = (out.writeStream.format("memory").queryName(qn).outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="ck-")).start())
    q.processAllAvailable()
    q.stop()
    batch = QUERIES[name](spark, SF_SMALL)
    cols = batch.columns
    got = closed(r for r in spark.table(qn).select(*cols).collect())
    want = closed(r for r in batch.collect())
    assert got == want


@pytest.mark.parametrize("name,profile", [("marketing_by_channel_5s", "marketing_by_channel_profile"),
                                          ("marketing_total_5s", "marketing_total_profile")])
def test_surveyed_windows_equal_the_batch_profile(spark, streams, tmp_path, name, profile):
    from eventide.operators import rollup_profile
    out = STREAM_JOBS[name](streams)
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(str(tmp_path / "out")).filter("window_end < '2030-01-01'")
    got = rollup_profile(got, ["channel", "behavior"])
    want = QUERIES[profile](spark, SF_SMALL)
    as_rows = lambda df: sorted((tuple(r) for r in df.select(*want.columns).collect()), key=str)
    assert as_rows(got) == as_rows(want)
