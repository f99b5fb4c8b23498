"""Streaming twins equal their batch twins on closed windows / keys."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, ts
from eventide.functions import equals_value, non_empty
from eventide.operators import (cap_per_key, consecutive_pairs, consecutive_run, interval_match, order_payment_status,
                                salted_count, sliding_count, top_n_per_window, unique_visitors)
from eventide.sources import Fixtures
from eventide.streaming import (split_channels, stream_cap_per_key, stream_consecutive_run, stream_interval_join,
                                stream_order_payment_status, stream_salted_count, stream_sliding_count, stream_top_n,
                                stream_unique_visitors, with_event_time, wm_safe_filter)
from eventide.streaming.harness import read_ordered_files, write_ordered_files

FAR = ts("2031-01-01 00:00:00")


def replay(spark, df, flush, n_files=6, order="seq"):
    folder = tempfile.mkdtemp(prefix="stream-src-")
    write_ordered_files(df, folder, n_files, order, flush_row=flush)
    return read_ordered_files(spark, folder, df.schema)


def run(spark, out, mode="append"):
    name = "q" + next(tempfile._get_candidate_names())
    q = (out.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="ckpt-")).start())
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def as_set(df, cols, before=FAR):
    res = set()
    for r in df.collect():
        if all(not isinstance(r[c], dt.datetime) or r[c] < before - dt.timedelta(days=1) for c in cols):
            res.add(tuple(r[c] for c in cols))
    return res


@pytest.fixture(scope="module")
def ub(spark):
    return Fixtures(spark, SF_SMALL).user_behavior


def flush_ub(ub):
    return {"seq": 10 ** 9, "user_id": 1, "item_id": 1, "category_id": 1, "behavior": "pv", "ts": FAR}


def test_hot_items_twin(spark, ub):
    s = with_event_time(replay(spark, ub, flush_ub(ub)))
    pv = wm_safe_filter(s, equals_value("behavior", "pv"))
    counts = stream_sliding_count(pv, ["item_id"], "1 hour", "5 minutes", keep_window=True)
    got = run(spark, stream_top_n(counts, 5, "item_id"))
    batch = top_n_per_window(sliding_count(ub.filter("behavior = 'pv'"), ["item_id"], "1 hour", "5 minutes"), 5,
                             "item_id")
    cols = ["window_end", "rank", "item_id", "cnt"]
    assert as_set(got, cols) == as_set(batch, cols)


def test_pane_and_salted_and_uv_twins(spark, ub):
    s = with_event_time(replay(spark, ub, flush_ub(ub)))
    pv = wm_safe_filter(s, equals_value("behavior", "pv"))
    bpv = ub.filter("behavior = 'pv'")
    pane = run(spark, stream_sliding_count(pv, [], "1 hour", "10 minutes", strategy="pane"))
    assert as_set(pane, ["window_end", "cnt"]) == as_set(sliding_count(bpv, [], "1 hour", "10 minutes"),
                                                          ["window_end", "cnt"])
    salted = run(spark, stream_salted_count(pv, "1 hour"))
    assert as_set(salted, ["window_end", "cnt"]) == as_set(salted_count(bpv, [], "1 hour"), ["window_end", "cnt"])
    uv = run(spark, stream_unique_visitors(pv, "1 hour"))
    assert as_set(uv, ["window_end", "uv"]) == as_set(unique_visitors(bpv, "1 hour"), ["window_end", "uv"])


def test_watermark_safe_filter_keeps_watermark(spark, ub):
    # the flush row fails the filter: with wm_safe_filter it still closes the last windows
    flush = dict(flush_ub(ub), behavior="fav")
    s = with_event_time(replay(spark, ub, flush))
    got = run(spark, stream_sliding_count(wm_safe_filter(s, equals_value("behavior", "pv")), [], "1 hour"))
    batch = sliding_count(ub.filter("behavior = 'pv'"), [], "1 hour", "1 hour")
    assert as_set(got, ["window_end", "cnt"]) == as_set(batch, ["window_end", "cnt"])


def test_login_processor_twin(spark):
    lg = Fixtures(spark, SF_MID).login
    flush = {"seq": 10 ** 9, "user_id": 10 ** 6, "ip": "x", "login_state": "success", "ts": FAR}
    s = with_event_time(replay(spark, lg, flush, n_files=5))
    cols = ["user_id", "first_fail_ts", "last_fail_ts", "msg"]
    got = run(spark, stream_consecutive_run(s, 2, "6 hours"))
    assert as_set(got, cols) == as_set(consecutive_pairs(lg, "6 hours"), cols)
    got3 = run(spark, stream_consecutive_run(with_event_time(replay(spark, lg, flush, n_files=5)), 3))
    assert as_set(got3, cols) == as_set(consecutive_run(lg, 3), cols)


def test_cap_processor_twin(spark):
    ad = Fixtures(spark, SF_MID).ad_click
    flush = {"seq": 10 ** 9, "user_id": 10 ** 6, "ad_id": 0, "province": "P", "city": "c", "ts": FAR}
    out = run(spark, stream_cap_per_key(with_event_time(replay(spark, ad, flush, n_files=4)), cap=2))
    ch = split_channels(out, ["main", "blacklist"])
    b = cap_per_key(ad, ["user_id", "ad_id"], cap=2)
    cols = ["seq", "user_id", "ad_id", "province", "city", "ts"]
    assert as_set(ch["main"], cols) == as_set(b.passed, cols)
    assert as_set(ch["blacklist"], ["user_id", "ad_id", "day", "ts", "msg"]) == as_set(
        b.warnings.withColumnRenamed("warn_ts", "ts"), ["user_id", "ad_id", "day", "ts", "msg"])


def test_order_status_processor(spark):
    t0 = ts("2019-05-21 09:27:22")

    def ev(seq, o, t, s):
        return (seq, o, t, "" if t == "create" else f"tx{o}", t0 + dt.timedelta(seconds=s))
    schema = "seq long, order_id long, event_type string, tx_id string, ts timestamp_ntz"
    rows = [ev(0, 1, "create", 0), ev(1, 2, "create", 1), ev(2, 3, "create", 2), ev(3, 4, "pay", 5),
            ev(4, 5, "pay", 7), ev(5, 4, "create", 10), ev(6, 1, "pay", 60),
            ev(7, 3, "pay", 902), ev(8, 6, "create", 2000)]
    df = spark.createDataFrame(rows, schema)
    flush = {"seq": 10 ** 9, "order_id": 99, "event_type": "create", "tx_id": "", "ts": FAR}
    folder = tempfile.mkdtemp(prefix="orders-")
    write_ordered_files(df, folder, 2, "seq", flush_row=flush)
    s = with_event_time(read_ordered_files(spark, folder, df.schema))
    got = {(r.order_id, r.result) for r in run(spark, stream_order_payment_status(s, "900 seconds")).collect()}
    batch = {(r.order_id, r.result) for r in order_payment_status(df, "900 seconds").collect()}
    assert got == batch


def test_interval_join_twin(spark):
    fx = Fixtures(spark, SF_SMALL)
    pays = fx.order_events.filter(non_empty("tx_id")).select("tx_id", "order_id", "seq", "ts")
    recs = fx.receipts
    ps = with_event_time(replay(spark, pays, {"tx_id": "zz", "order_id": 0, "seq": 10 ** 9, "ts": FAR}, 4, "ts"))
    rs = with_event_time(replay(spark, recs, {"tx_id": "zy", "pay_channel": "x", "ts": FAR}, 4, "ts"))
    out = run(spark, stream_interval_join(ps, rs))
    ch = split_channels(out, ["matched", "unmatched_pays", "unmatched_receipts"])
    b = interval_match(pays, recs, left_order=["seq"], right_order=["pay_channel"])
    assert as_set(ch["matched"], ["tx_id", "pay_ts", "receipt_ts"]) == as_set(b.matched, ["tx_id", "pay_ts", "receipt_ts"])
    assert as_set(ch["unmatched_pays"], ["tx_id", "pay_ts"]) == as_set(b.unmatched_left, ["tx_id", "pay_ts"])
    assert as_set(ch["unmatched_receipts"], ["tx_id", "receipt_ts"]) == as_set(b.unmatched_right,
                                                                             ["tx_id", "receipt_ts"])


def test_followed_by_and_burst_processors(spark):
    from eventide.operators import fail_bursts, followed_by
    from eventide.streaming import stream_fail_bursts, stream_followed_by
    fx = Fixtures(spark, SF_SMALL)
    oe = fx.order_events
    flush = {"seq": 10 ** 12, "order_id": 10 ** 9, "event_type": "create", "tx_id": "", "ts": FAR}
    out = run(spark, stream_followed_by(with_event_time(replay(spark, oe, flush, 4, "ts")), "900 seconds"))
    fb = followed_by(oe, "900 seconds")
    assert as_set(out.filter("result = 'payed'"), ["order_id", "create_ts", "end_ts"]) == as_set(
        fb.matched, ["order_id", "create_ts", "pay_ts"])
    assert as_set(out.filter("result = 'timeout'"), ["order_id", "create_ts", "end_ts"]) == as_set(
        fb.timeouts, ["order_id", "create_ts", "timeout_ts"])
    lg = Fixtures(spark, SF_MID).login
    lflush = {"seq": 10 ** 9, "user_id": 10 ** 6, "ip": "x", "login_state": "success", "ts": FAR}
    got = run(spark, stream_fail_bursts(with_event_time(replay(spark, lg, lflush, 5)), "24 hours", 2))
    cols = ["user_id", "first_fail_ts", "last_fail_ts", "fail_count", "msg"]
    assert as_set(got, cols) == as_set(fail_bursts(lg, "24 hours", 2), cols)


@pytest.mark.parametrize("salts", [1, 32])
def test_running_uv_job_equals_batch(spark, ub, tmp_path, salts):
    from eventide.operators import running_unique_visitors
    from eventide.streaming import write_running_unique_visitors
    spv = wm_safe_filter(with_event_time(replay(spark, ub, flush_ub(ub))), equals_value("behavior", "pv"))
    q = write_running_unique_visitors(spv, "uv", str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"), salts=salts)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch").distinct().count() > 2  # counts go on from batch to batch
    cols = ["window_end", "bit_offset", "ts", "seq", "user_id", "uv"]
    assert as_set(got, cols) == as_set(running_unique_visitors(ub.filter("behavior = 'pv'")), cols)


def test_running_uv_batch_run_twice_gives_its_rows_once(spark, tmp_path):
    from eventide.streaming import running
    t0 = ts("2024-01-01 00:00:00")
    h = dt.timedelta(hours=1)

    def batch(*seqs):
        return spark.createDataFrame([(t0 + h, s, t0 + dt.timedelta(seconds=s), s, s, t0 + dt.timedelta(seconds=s + 1))
                                      for s in seqs],
                                     "window_end timestamp, bit_offset long, ts timestamp, seq long, user_id long, at timestamp")
    totals, out = str(tmp_path / "totals"), str(tmp_path / "out")
    for k in range(running.SLOTS):
        spark.createDataFrame([(None, 0, -1)], running._TOTALS).write.parquet(f"{totals}/slot{k}")
    for i, seqs in enumerate([(1, 2, 3), (4, 5), (4, 5), (), (9,), (10, 11)]):
        running.number_batch(batch(*seqs), [0, 1, 1, 2, 3, 4][i], totals, out)
    got = {(r.seq, r.uv, r.batch) for r in spark.read.parquet(out).collect()}
    assert got == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (5, 5, 1), (9, 6, 3), (10, 7, 4), (11, 8, 4)}


def test_allowed_lateness_and_sinks(spark, tmp_path):
    from eventide.streaming.sinks import write_channels, write_stream
    from eventide.streaming.twins import stream_counts_with_lateness
    t0 = ts("2024-01-01 00:00:00")
    rows = [(0, "/a", t0 + dt.timedelta(seconds=10)), (1, "/a", t0 + dt.timedelta(seconds=70)),
            (2, "/a", t0 + dt.timedelta(seconds=20)),     # 50 s late: inside 30 s delay + 60 s lateness
            (3, "/a", FAR)]
    df = spark.createDataFrame(rows, "seq long, url string, ts timestamp_ntz")
    folder = tempfile.mkdtemp(prefix="lateness-")
    write_ordered_files(df, folder, 4, "seq")
    raw = read_ordered_files(spark, folder, df.schema)
    counts, mode = stream_counts_with_lateness(raw, ["url"], "1 minute", "1 minute", "30 seconds", "1 minute")
    name = "late" + next(tempfile._get_candidate_names())
    q = write_stream(counts, name, mode=mode, checkpoint=str(tmp_path / "ck1"))
    q.processAllAvailable()
    q.stop()
    got = {(r.url, r.window_end, r.cnt) for r in spark.table(name).collect()}
    assert ("/a", t0 + dt.timedelta(minutes=1), 2) in got and ("/a", t0 + dt.timedelta(minutes=2), 1) in got
    # named side outputs written per micro-batch
    tagged = read_ordered_files(spark, folder, df.schema).withColumn(
        "channel", F.when(F.col("seq") % 2 == 0, "even").otherwise("odd"))
    q2 = write_channels(tagged, "chan", str(tmp_path / "out"), ["even", "odd"], checkpoint=str(tmp_path / "ck2"))
    q2.processAllAvailable()
    q2.stop()
    even = spark.read.parquet(str(tmp_path / "out" / "channel=even"))
    assert sorted(r.seq for r in even.collect()) == [0, 2]


def test_top_n_of_many_keys_equals_batch(spark, tmp_path):
    """100,000 keys in each of two windows; no plan node gathers them."""
    from eventide.operators import sliding_count, top_n_per_window
    from eventide.streaming import stream_sliding_count, stream_top_n
    t0 = "timestamp_ntz'2024-01-01 00:00:00'"
    n = F.when(F.col("id") % 1000 == 7, 5).otherwise(1) + (F.col("id") % 3 == 0).cast("int")
    rows = (spark.range(200_000).select((F.col("id") % 100_000).alias("item_id"), "id", n.alias("n"))
            .select("item_id", "id", F.explode(F.sequence(F.lit(1), "n")).alias("r"))
            .select("item_id", (F.col("id") * 10 + F.col("r")).alias("seq"),
                    F.expr(f"{t0} + make_dt_interval(0, 0, 0, id div 100000 * 3600 + id % 3000)").alias("ts")))
    src = str(tmp_path / "keys")
    flush = spark.createDataFrame([(1, 10 ** 9, FAR)], rows.schema)
    rows.unionByName(flush).coalesce(1).sortWithinPartitions("seq").write.parquet(src)
    s = with_event_time(spark.readStream.schema(rows.schema).parquet(src))
    counts = stream_sliding_count(s, ["item_id"], "1 hour", keep_window=True)
    out = stream_top_n(counts, 4, "item_id")
    got = run(spark, out).collect()
    want = top_n_per_window(sliding_count(rows, ["item_id"], "1 hour", "1 hour"), 4, "item_id").collect()
    key = lambda r: (r.window_end.replace(tzinfo=None), r["rank"], r.item_id, r.cnt)
    assert sorted(map(key, want)) == sorted(key(r) for r in got if r.window_end.year < 2030)
