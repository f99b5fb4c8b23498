
from conftest import SF_MID, rows, ts
from eventide.operators import running_unique_visitors, unique_visitors, unique_visitors_bitmap, unique_visitors_hll
from eventide.sources import Fixtures


def test_bitmap_equals_exact_for_short_ids(spark):
    pv = Fixtures(spark, SF_MID).user_behavior.filter("behavior = 'pv'")
    exact = rows(unique_visitors(pv))
    assert rows(unique_visitors_bitmap(pv)) == exact
    assert rows(unique_visitors_bitmap(pv, method="distinct")) == exact
    small = dict(rows(unique_visitors_bitmap(pv, cap=1 << 6)))
    assert all(small[w] <= n for w, n in exact) and any(small[w] < n for w, n in exact)


def test_long_ids_collide(spark):
    t = ts("2024-01-01 00:10:00")
    ids = [10 ** 12 + i * 7919 for i in range(3000)]
    df = spark.createDataFrame([(i, t) for i in ids], "user_id long, ts timestamp_ntz")
    exact = rows(unique_visitors(df))[0][1]
    bm = rows(unique_visitors_bitmap(df, cap=1 << 12))[0][1]
    assert exact == 3000 and bm < exact


def test_hll_close_to_exact(spark):
    pv = Fixtures(spark, SF_MID).user_behavior
    exact = dict(rows(unique_visitors(pv, "1 day")))
    approx = dict(rows(unique_visitors_hll(pv, "1 day")))
    for w, n in exact.items():
        assert abs(approx[w] - n) <= 0.05 * n + 1


def test_running_unique_visitors(spark):
    h = "2024-01-01 00:"
    df = spark.createDataFrame([(1, 5, ts(h + "00:01")), (2, 6, ts(h + "00:02")), (3, 5, ts(h + "00:03")),
                                (4, 7, ts(h + "00:03")), (5, 8, ts("2024-01-01 01:00:00"))],
                               "seq long, user_id long, ts timestamp_ntz")
    got = rows(running_unique_visitors(df, bucket="1 second"), "seq", "user_id", "uv")
    assert got == [(1, 5, 1), (2, 6, 2), (4, 7, 3), (5, 8, 1)]


def test_hll_methods_agree_roughly(spark):
    pv = Fixtures(spark, SF_MID).user_behavior
    exact = dict(rows(unique_visitors(pv, "1 day")))
    hllpp = dict(rows(unique_visitors_hll(pv, "1 day", method="hllpp")))
    for w, n in exact.items():
        assert abs(hllpp[w] - n) <= 0.05 * n + 1
