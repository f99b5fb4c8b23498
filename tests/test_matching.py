import datetime as dt

from conftest import SF_MID, rows, ts
from eventide.operators import interval_match, split_late
from eventide.plans import QUERIES

T0 = ts("2019-05-21 09:27:22")


def test_match_shapes(spark):
    pays = spark.createDataFrame([("p1", 1, 0, T0 + dt.timedelta(seconds=2)), ("p2", 2, 1, T0 + dt.timedelta(seconds=3)),
                                  ("p3", 3, 2, T0 + dt.timedelta(seconds=1006))],
                                 "tx_id string, order_id long, seq long, ts timestamp_ntz")
    recs = spark.createDataFrame([("p9", "alipay", T0 + dt.timedelta(seconds=2)),
                                  ("p2", "wechat", T0 + dt.timedelta(seconds=8)),
                                  ("p3", "wechat", T0 + dt.timedelta(seconds=1000))],
                                 "tx_id string, pay_channel string, ts timestamp_ntz")
    m = interval_match(pays, recs, "tx_id", "5 seconds", left_order=["seq"], right_order=["pay_channel"])
    assert rows(m.matched, "tx_id") == [("p2",)]          # |diff| = 5 s is inclusive
    assert rows(m.unmatched_left, "tx_id") == [("p1",), ("p3",)]
    assert rows(m.unmatched_right, "tx_id") == [("p3",), ("p9",)]


def test_matched_plus_unmatched_cover_inputs(spark):
    m, up, ur = (QUERIES[q](spark, SF_MID) for q in ("pay_receipt_match", "unmatched_pays", "unmatched_receipts"))
    from eventide.sources import Fixtures
    fx = Fixtures(spark, SF_MID)
    assert m.count() + up.count() == fx.order_events.filter("tx_id <> ''").count()
    assert m.count() + ur.count() == fx.receipts.count()


def test_late_rows(spark):
    def at(s):
        return T0 + dt.timedelta(seconds=s)
    df = spark.createDataFrame([(0, at(0), "/a"), (1, at(1000), "/a"), (2, at(100), "/a"), (3, at(900), "/b")],
                               "seq long, ts timestamp_ntz, url string")
    # 10 min / 1 min windows, 1 min delay and lateness: wm before seq 2 = at(940)
    sp = split_late(df, "10 minutes", "1 minute", "1 minute", "1 minute")
    assert rows(sp.late, "seq") == [(2,)]
    assert rows(sp.on_time, "seq") == [(0,), (1,), (3,)]


def test_late_rows_small_buckets(spark):
    def at(s):
        return T0 + dt.timedelta(seconds=s)
    evs = [(i, at(i * 10), "/a") for i in range(50)] + [(50, at(5), "/b"), (51, at(600), "/c")]
    df = spark.createDataFrame(evs, "seq long, ts timestamp_ntz, url string")
    for rpb in (1, 3, 1 << 20):
        sp = split_late(df, "1 minute", "10 seconds", "0 seconds", "0 seconds", rows_per_bucket=rpb)
        assert rows(sp.late, "seq") == [(50,)]
