import datetime as dt
import random

from conftest import rows, ts
from eventide.operators import interval_match

T0 = ts("2019-05-21 00:00:00")
PAY, RECEIPT = "tx_id string, seq long, ts timestamp_ntz", "tx_id string, pay_channel string, ts timestamp_ntz"


def test_a_stray_pay_does_not_shift_later_pairs(spark):
    pays = spark.createDataFrame([("t", 0, T0), ("t", 1, T0 + dt.timedelta(hours=20))], PAY)
    recs = spark.createDataFrame([("t", "a", T0 + dt.timedelta(hours=20, seconds=1))], RECEIPT)
    m = interval_match(pays, recs, left_order=["seq"])
    assert rows(m.matched, "pay_seq", "receipt_pay_channel") == [(1, "a")]
    assert rows(m.unmatched_left, "pay_seq") == [(0,)] and rows(m.unmatched_right) == []


def test_repeated_ids_against_a_loop(spark):
    rng = random.Random(5)
    at = lambda: T0 + dt.timedelta(milliseconds=250 * rng.randint(-400, 400))
    pays = [(rng.choice(["a", "b", None]), i, at()) for i in range(90)] + [("a", 99, None)]
    recs = [(rng.choice(["a", "b", "c", None]), f"r{i}", at()) for i in range(90)] + [("a", "r99", None)]
    for bound in (0, 1, 5, 0.5):
        near = [(p, r) for p in pays for r in recs if None not in (p[0], p[2], r[2]) and p[0] == r[0]
                and abs(p[2] - r[2]) <= dt.timedelta(seconds=bound)]
        m = interval_match(spark.createDataFrame(pays, PAY), spark.createDataFrame(recs, RECEIPT), "tx_id", bound)
        assert rows(m.matched, "pay_seq", "receipt_pay_channel") == sorted((p[1], r[1]) for p, r in near)
        assert rows(m.unmatched_left, "pay_seq") == sorted((p[1],) for p in pays if p not in [x for x, _ in near])
        assert rows(m.unmatched_right, "receipt_pay_channel") == sorted((r[1],) for r in recs if r not in [x for _, x in near])


def python_one_to_one(pays, recs, bound):
    """Every event pairs with the longest waiting one of the other side in range, or waits."""
    events = sorted([(p[2], 0, p[1], p) for p in pays if None not in (p[0], p[2])]
                    + [(r[2], 1, r[1], r) for r in recs if None not in (r[0], r[2])], key=lambda e: e[:3])
    waiting, out = {}, []
    for t, side, _, e in events:
        queue = waiting.setdefault((e[0], 1 - side), [])
        while queue and queue[0][2] < t - bound:
            queue.pop(0)
        if queue:
            o = queue.pop(0)
            out.append((e[1], o[1]) if side == 0 else (o[1], e[1]))
        else:
            waiting.setdefault((e[0], side), []).append(e)
    return sorted(out)


def repeated(seed):
    rng = random.Random(seed)
    at = lambda: T0 + dt.timedelta(milliseconds=500 * rng.randint(-4000, 4000))
    pays = [(rng.choice(["a", "a", "a", "b", None]), i, at()) for i in range(700)] + [("a", 999, None)]
    recs = [(rng.choice(["a", "a", "b", "c", None]), f"r{i:03d}", at()) for i in range(700)] + [("a", "r999", None)]
    return pays, recs


def test_one_to_one_equals_a_loop(spark):
    for seed, bound in ((1, 0), (2, 1), (3, 5), (4, 60)):
        pays, recs = repeated(seed)
        m = interval_match(spark.createDataFrame(pays, PAY), spark.createDataFrame(recs, RECEIPT), "tx_id", bound,
                           left_order=["seq"], right_order=["pay_channel"], pairing="one")
        want = python_one_to_one(pays, recs, dt.timedelta(seconds=bound))
        assert rows(m.matched, "pay_seq", "receipt_pay_channel") == want
        assert rows(m.unmatched_left, "pay_seq") == sorted((p[1],) for p in pays if p[1] not in {x for x, _ in want})
        assert rows(m.unmatched_right, "receipt_pay_channel") == sorted(
            (r[1],) for r in recs if r[1] not in {x for _, x in want})


def test_first_pairing_looks_at_first_events_only(spark):
    pays, recs = repeated(6)
    m = interval_match(spark.createDataFrame(pays, PAY), spark.createDataFrame(recs, RECEIPT), "tx_id", "10 minutes",
                       left_order=["seq"], right_order=["pay_channel"], pairing="first")
    first = lambda side: {k: min((e[2], e[1]) for e in side if e[0] == k and e[2]) for k in "abc"
                          if any(e[0] == k and e[2] for e in side)}
    p, r = first(pays), first(recs)
    want = sorted((p[k][1], r[k][1]) for k in p if k in r and abs(p[k][0] - r[k][0]) <= dt.timedelta(minutes=10))
    assert rows(m.matched, "pay_seq", "receipt_pay_channel") == want


def test_pairings_agree_on_unique_ids(spark):
    from conftest import SF_SMALL
    from eventide.functions import non_empty
    from eventide.sources import Fixtures
    fx = Fixtures(spark, SF_SMALL)
    pays = fx.order_events.filter(non_empty("tx_id")).select("tx_id", "order_id", "seq", "ts")
    every, first, one = (interval_match(pays, fx.receipts, pairing=p) for p in ("all", "first", "one"))
    for a, b, c in zip(every, first, one):
        assert rows(a) == rows(b) == rows(c)


def test_one_to_one_query_has_pairs(spark):
    from conftest import SF_SMALL
    from eventide.plans import QUERIES
    got = QUERIES["pay_receipt_one_to_one"](spark, SF_SMALL).collect()
    assert got and len({r.pay_seq for r in got}) == len(got) == len({r.receipt_order_id for r in got})


def test_one_to_one_stream_equals_the_loop(spark, tmp_path):
    import tempfile

    from eventide.streaming import stream_one_to_one, with_event_time
    from eventide.streaming.harness import read_ordered_files, write_ordered_files
    far = ts("2031-01-01 00:00:00")
    pays, recs = repeated(11)
    pays = [p for p in pays if None not in (p[0], p[2])]
    recs = [r for r in recs if None not in (r[0], r[2])]

    def stream(side, schema, last):
        df = spark.createDataFrame(side, schema)
        folder = tempfile.mkdtemp(prefix="one-")
        write_ordered_files(df, folder, 5, "ts", flush_row=dict(zip(df.columns, last)))
        return with_event_time(read_ordered_files(spark, folder, df.schema))

    out = stream_one_to_one(stream(pays, PAY, ("zz", 10 ** 6, far)), stream(recs, RECEIPT, ("zy", "z", far)), bound=5)
    q = (out.writeStream.format("memory").queryName("one_to_one").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("one_to_one")
    want = python_one_to_one(pays, recs, dt.timedelta(seconds=5))
    assert rows(got.filter("channel = 'matched'"), "pay_seq", "receipt_pay_channel") == want
    by_seq = {p[1]: p for p in pays}
    assert all(r.pay_ts == by_seq[r.pay_seq][2] and r.tx_id == by_seq[r.pay_seq][0]
               for r in got.filter("channel = 'matched'").collect())
    assert rows(got.filter("channel = 'unmatched_pays' and tx_id < 'z'"), "pay_seq") == sorted(
        (p[1],) for p in pays if p[1] not in {x for x, _ in want})
    assert rows(got.filter("channel = 'unmatched_receipts' and tx_id < 'z'"), "receipt_pay_channel") == sorted(
        (r[1],) for r in recs if r[1] not in {x for _, x in want})
