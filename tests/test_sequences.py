import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, rows, ts
from eventide.operators import (consecutive_pairs, consecutive_run, fail_bursts, followed_by,
                                order_payment_status)
from eventide.sources import Fixtures

T0 = ts("2019-05-21 09:27:12")


def logins(spark, evs, user=7):
    """evs: list of (seconds offset, state)"""
    return spark.createDataFrame(
        [(i, user, "10.0.0.1", st, T0 + dt.timedelta(seconds=o)) for i, (o, st) in enumerate(evs)],
        "seq long, user_id long, ip string, login_state string, ts timestamp_ntz")


def test_pair_boundary_inclusive_and_strict(spark):
    df = logins(spark, [(0, "fail"), (2, "fail"), (10, "fail"), (13, "fail")])
    inc = rows(consecutive_pairs(df, "2 seconds"), "first_fail_ts", "last_fail_ts")
    assert inc == [(T0, T0 + dt.timedelta(seconds=2))]
    assert consecutive_pairs(df, "2 seconds", inclusive=False).count() == 0
    assert consecutive_pairs(df, "2 seconds").first().msg == "login fail in 2s for 2tiems"


def test_success_breaks_pairs_and_order_by_time(spark):
    # out-of-order arrival: sorted by (ts, seq) the success sits between the fails
    df = logins(spark, [(0, "fail"), (2, "fail"), (1, "success")])
    assert consecutive_pairs(df, "2 seconds").count() == 0
    # the sample shape: fail, fail, success, success (one pair out of order), fail
    df = logins(spark, [(20, "fail"), (21, "fail"), (23, "success"), (22, "success"), (24, "fail")])
    assert rows(consecutive_pairs(df, "2 seconds"), "first_fail_ts") == [(T0 + dt.timedelta(seconds=20),)]
    assert fail_bursts(df, "2 seconds", 2).count() == 0  # the success at +22 discards the burst
    assert consecutive_run(df, 8).count() == 0


def test_run_of_nine_gives_two_rows(spark):
    df = logins(spark, [(i, "fail") for i in range(9)] + [(9, "success"), (10, "fail")])
    got = rows(consecutive_run(df, 8), "first_fail_ts", "last_fail_ts")
    assert got == [(T0, T0 + dt.timedelta(seconds=7)), (T0 + dt.timedelta(seconds=1), T0 + dt.timedelta(seconds=8))]
    assert consecutive_run(df, 8).first().msg == "login fail 8 times in 2s"


@pytest.mark.parametrize("bucket", ["1 second", "7 seconds", "1 hour", "3650 days"])
def test_bucket_width_does_not_change_results(spark, bucket):
    lg = Fixtures(spark, SF_MID).login
    ref_runs = rows(consecutive_run(lg, 3, bucket="1 hour"))
    assert rows(consecutive_run(lg, 3, bucket=bucket)) == ref_runs
    ref_pairs = rows(consecutive_pairs(lg, "6 hours", bucket="1 hour"))
    assert rows(consecutive_pairs(lg, "6 hours", bucket=bucket)) == ref_pairs


def python_bursts(evs, window, min_fails):
    """Plain replay of the burst rule over (t, is_fail) sorted events."""
    out, anchor, last, cnt = [], None, None, 0
    for t, f in evs:
        if anchor is not None and t > anchor + window:
            if cnt >= min_fails:
                out.append((anchor, last, cnt))
            anchor, cnt = None, 0
        if not f:
            anchor, cnt = None, 0
            continue
        if anchor is None:
            anchor, cnt = t, 0
        last, cnt = t, cnt + 1
    if anchor is not None and cnt >= min_fails:
        out.append((anchor, last, cnt))
    return out


def test_bursts_equal_python_replay(spark):
    lg = Fixtures(spark, "/root/testdata/sf0.001").login
    w = dt.timedelta(hours=24)
    expected = []
    by_user = {}
    for r in lg.orderBy("ts", "seq").collect():
        by_user.setdefault(r.user_id, []).append((r.ts, r.login_state == "fail"))
    for u, evs in by_user.items():
        expected += [(u, a, b, c) for a, b, c in python_bursts(evs, w, 2)]
    for bucket in ("1 minute", "1 hour"):
        got = rows(fail_bursts(lg, "24 hours", 2, bucket=bucket), "user_id", "first_fail_ts", "last_fail_ts",
                   "fail_count")
        assert got == sorted(expected)


def orders(spark, evs):
    """evs: (order_id, type, tx, seconds offset)"""
    return spark.createDataFrame(
        [(i, o, t, tx, T0 + dt.timedelta(seconds=s)) for i, (o, t, tx, s) in enumerate(evs)],
        "seq long, order_id long, event_type string, tx_id string, ts timestamp_ntz")


def test_followed_by_and_status(spark):
    df = orders(spark, [(1, "create", "", 0), (1, "pay", "a", 60),          # paid in time
                        (2, "create", "", 1),                                # never paid
                        (3, "create", "", 2), (3, "pay", "b", 902),          # exactly 900 s: timeout
                        (4, "pay", "c", 5), (4, "create", "", 10),           # pay first
                        (5, "pay", "d", 7)])                                 # no create
    fb = followed_by(df, "900 seconds")
    assert rows(fb.matched, "order_id") == [(1,)]
    assert rows(fb.timeouts, "order_id", "timeout_ts") == [
        (2, T0 + dt.timedelta(seconds=901)), (3, T0 + dt.timedelta(seconds=902)), (4, T0 + dt.timedelta(seconds=910))]
    st = dict(rows(order_payment_status(df, "900 seconds"), "order_id", "result"))
    assert st == {1: "payed successfully", 2: "timeout", 3: "payed but timeout", 4: "pay successfully",
                  5: "payed but not found create"}


def test_narrow_buckets_keep_results(spark):
    lg = Fixtures(spark, SF_MID).login
    assert rows(consecutive_run(lg, 3, bucket="1 second")) == rows(consecutive_run(lg, 3, bucket="365 days"))
    assert rows(fail_bursts(lg, "24 hours", 2, bucket="30 days")) == rows(fail_bursts(lg, "24 hours", 2))
    oe = Fixtures(spark, SF_MID).order_events
    wide, narrow = followed_by(oe, "900 seconds", bucket="365 days"), followed_by(oe, "900 seconds", bucket="1 second")
    assert rows(wide.matched) == rows(narrow.matched) and rows(wide.timeouts) == rows(narrow.timeouts)


def python_runs(evs, n, within=None, inclusive=True):
    """Plain replay of (seq, user, state, ts) rows."""
    out, by_user = [], {}
    for s, u, st, t in sorted(evs, key=lambda e: (e[3], e[0])):
        run = by_user.setdefault(u, [])
        run.append(t) if st == "fail" else run.clear()
        if len(run) >= n:
            gap = run[-1] - run[-n]
            if within is None or gap < within or (inclusive and gap == within):
                out.append((u, run[-n], run[-1]))
    return sorted(out)


@pytest.mark.parametrize("bucket", ["1 second", "1 minute", "1 hour"])
def test_hot_key_is_split_across_buckets(spark, bucket):
    """One user owns most rows, all inside one hour, many at the same instant."""
    import random
    rnd = random.Random(5)
    evs = [(i, 1, "fail" if rnd.random() < 0.7 else "success", T0 + dt.timedelta(milliseconds=250 * (i // 3 * 3)))
           for i in range(3000)]
    evs += [(5000 + i, 2, "fail", T0 + dt.timedelta(seconds=7 * i)) for i in range(10)]
    df = spark.createDataFrame(evs, "seq long, user_id long, login_state string, ts timestamp_ntz")
    cols = ["user_id", "first_fail_ts", "last_fail_ts"]
    for n in (1, 2, 3, 8):
        assert rows(consecutive_run(df, n, bucket=bucket), *cols) == python_runs(evs, n)
    two = dt.timedelta(seconds=2)
    for n, inclusive in ((2, True), (2, False), (4, True)):
        got = consecutive_run(df, n, within="2 seconds", inclusive=inclusive, bucket=bucket)
        assert rows(got, *cols) == python_runs(evs, n, two, inclusive)


def python_followed(evs, within):
    matched, timeouts = [], []
    for s, o, kind, _, t in evs:
        if kind == "create":
            pays = [(p, q) for q, r, k, _, p in evs if r == o and k == "pay" and (p, q) > (t, s)]
            if pays and min(pays)[0] - t < within:
                matched.append((o, t, min(pays)[0]))
            else:
                timeouts.append((o, t, t + within))
    return sorted(matched), sorted(timeouts)


@pytest.mark.parametrize("bucket", ["1 second", "1 hour"])
def test_followed_by_equals_plain_replay(spark, bucket):
    import random
    rnd = random.Random(8)
    df = orders(spark, [(rnd.choice([1, 1, 1, 2, 3]), rnd.choice(["create", "pay", "other"]), "", rnd.choice([0, 900, 1800, 3600])
                         + rnd.randint(0, 4000)) for _ in range(300)] + [(4, "create", "", 0), (4, "pay", "", 900),
                                                                          (5, "pay", "", 7), (5, "create", "", 7)])
    evs = [tuple(r) for r in df.collect()]
    fb = followed_by(df, "900 seconds", bucket=bucket)
    got = rows(fb.matched, "order_id", "create_ts", "pay_ts"), rows(fb.timeouts, "order_id", "create_ts", "timeout_ts")
    assert got == python_followed(evs, dt.timedelta(seconds=900))


@pytest.mark.parametrize("name,exchanges", [("order_paid", 1), ("order_timeouts", 1), ("login_fail_pairs", 1),
                                            ("login_fail_pairs_strict", 1), ("login_fail_runs", 3),
                                            ("login_fail_runs_default", 3)])
def test_shuffles_of_sequence_queries(spark, name, exchanges):
    import re
    from eventide.plans import QUERIES
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"(?<!\], )Exchange hashpartitioning", plan)) == exchanges  # those reused: "[..], Exchange"
    # a create and a pay are two projections of one orders row
    assert len(re.findall(r"FileScan parquet", plan)) <= 2


@pytest.mark.parametrize("bucket", ["2 seconds", "7 seconds", "1 hour"])
def test_bursts_of_a_bot(spark, bucket):
    """One user failing every 0.7 s for a long time: bursts run through every bucket."""
    evs = [(i, 1, "x", "fail", T0 + dt.timedelta(milliseconds=700 * i)) for i in range(600)]
    evs += [(600, 1, "x", "success", T0 + dt.timedelta(milliseconds=700 * 599 + 900))]
    df = spark.createDataFrame(evs, "seq long, user_id long, ip string, login_state string, ts timestamp_ntz")
    expected = python_bursts([(r[4], r[3] == "fail") for r in evs], dt.timedelta(seconds=2), 2)
    got = rows(fail_bursts(df, "2 seconds", 2, bucket=bucket), "first_fail_ts", "last_fail_ts", "fail_count")
    assert got == sorted(expected)


def test_bursts_of_random_logins_in_narrow_buckets(spark):
    """Ties, successes inside bursts, gaps over several buckets, a null key."""
    import random
    rnd = random.Random(7)
    evs, t = [], 0
    for i in range(4000):
        t += rnd.choice([0, 0, 100, 300, 700, 1000, 1900, 2000, 2001, 9000])
        evs.append((i, rnd.choice([1, 1, 1, 2, None]), "x", "fail" if rnd.random() < 0.93 else "success",
                    T0 + dt.timedelta(milliseconds=t)))
    df = spark.createDataFrame(evs, "seq long, user_id long, ip string, login_state string, ts timestamp_ntz")
    want = sorted((str(u), a, b, n) for u in (1, 2, None) for a, b, n in python_bursts(
        [(e[4], e[3] == "fail") for e in evs if e[1] == u], dt.timedelta(seconds=2), 2))
    for bucket in ("2 seconds", "5 seconds", "1 day"):
        got = fail_bursts(df, "2 seconds", 2, bucket=bucket).select(
            F.coalesce(F.col("user_id").cast("string"), F.lit("None")).alias("u"), "first_fail_ts", "last_fail_ts", "fail_count")
        assert rows(got) == want


def test_calling_a_sequence_query_runs_no_job(spark):
    from eventide.plans import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "queries that are only built")
    try:
        for name in ("login_fail_bursts", "login_fail_runs", "login_fail_pairs", "order_paid", "pay_receipt_one_to_one"):
            QUERIES[name](spark, "/root/testdata/sf0.001").schema
        # reading the schema of a Parquet folder is a job of its own, with one task
        sizes = [tracker.getJobInfo(j).stageIds for j in tracker.getJobIdsForGroup("lazy")]
        assert all(len(s) == 1 and tracker.getStageInfo(s[0]).numTasks == 1 for s in sizes)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
