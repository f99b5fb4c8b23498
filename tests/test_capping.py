import datetime as dt

from conftest import rows, ts
from eventide.operators import cap_per_key


def clicks(spark, times, user=1, ad=9):
    return spark.createDataFrame([(i, user, ad, "P", "C", t) for i, t in enumerate(times)],
                                 "seq long, user_id long, ad_id long, province string, city string, ts timestamp_ntz")


def test_cap_boundary_and_single_warning(spark):
    base = ts("2024-01-01 01:00:00")
    df = clicks(spark, [base + dt.timedelta(seconds=i) for i in range(103)])
    c = cap_per_key(df, ["user_id", "ad_id"], cap=100)
    assert c.passed.count() == 100
    w = c.warnings.collect()
    assert len(w) == 1 and w[0].msg == "click over100times" and w[0].warn_ts == base + dt.timedelta(seconds=100)


def test_day_rolls_at_16_utc(spark):
    # 15:59:59 UTC and 16:00:00 UTC fall on different UTC+8 days
    df = clicks(spark, [ts("2024-01-01 15:59:58"), ts("2024-01-01 15:59:59"), ts("2024-01-01 16:00:00"),
                        ts("2024-01-01 16:00:01")])
    c = cap_per_key(df, ["user_id", "ad_id"], cap=1, day_offset_hours=8)
    assert c.passed.count() == 2
    assert rows(c.warnings, "day") == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)]


def test_ties_broken_by_seq(spark):
    t = ts("2024-01-01 00:00:00")
    df = clicks(spark, [t, t, t])
    assert rows(cap_per_key(df, ["user_id", "ad_id"], cap=2).passed, "seq") == [(0,), (1,)]


def test_large_caps_need_no_full_key_sort_and_agree(spark):
    base = ts("2024-01-01 01:00:00")
    df = clicks(spark, [base + dt.timedelta(seconds=7 * i) for i in range(1500)])
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    want = rows(cap_per_key(df, ["user_id", "ad_id"], cap=900).passed), rows(
        cap_per_key(df, ["user_id", "ad_id"], cap=900).warnings)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        c = cap_per_key(df, ["user_id", "ad_id"], cap=900)
        assert (rows(c.passed), rows(c.warnings)) == want
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    c = cap_per_key(df, ["user_id", "ad_id"], cap=5000)
    assert c.passed.count() == 1500 and c.warnings.count() == 0
