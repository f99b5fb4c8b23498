"""Streams whose rows come out of order: every row is counted or late, never both, and late counts fire again."""

import datetime as dt
import random
import tempfile
from collections import Counter, defaultdict

import pytest

from conftest import ts
from eventide.__main__ import main
from eventide.operators import sliding_count_with_lateness, split_late
from eventide.streaming import (latest_counts, stream_final_counts, stream_top_n, stream_windows_with_late,
                                with_event_time)
from eventide.streaming.harness import read_ordered_files, write_ordered_files

T0 = ts("2024-01-01 12:00:00")
SIZE, SLIDE, LATE, DELAY = 600, 60, 60, 60
FAR = ts("2031-01-01 00:00:00")


def run(out):
    name = "lw" + next(tempfile._get_candidate_names())
    q = (out.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="ck-")).start())
    q.processAllAvailable()
    q.stop()
    return out.sparkSession.table(name)


def model(files, size=SIZE, slide=SLIDE, lateness=LATE, delay=DELAY):
    """Counts, late rows and firings of a replay in which each file is a micro-batch."""
    def closed(end, wm):
        return wm is not None and end - dt.timedelta(milliseconds=1) <= wm

    wm, late, counts, late_fires, top = None, set(), Counter(), 0, None
    for rows in files:
        for seq, url, t in rows:
            sec = (t - T0).total_seconds()
            first = T0 + dt.timedelta(seconds=sec // slide * slide + slide)
            ends = [first + dt.timedelta(seconds=i * slide) for i in range(size // slide)]
            still = [e for e in ends if not closed(e + dt.timedelta(seconds=lateness), wm)]
            if not still:
                late.add(seq)
            for e in still:
                counts[url, e] += 1
                late_fires += closed(e, wm)
        top = max([t for _, _, t in rows] + ([top] if top else []))
        wm = top - dt.timedelta(seconds=delay)
        wm = wm.replace(microsecond=wm.microsecond // 1000 * 1000)
    return counts, late, late_fires


def replay(spark, files):
    """Every list of rows becomes one file, in order."""
    flat, chunk = [], []
    for i, rows in enumerate([*files, [(10 ** 9, "/flush", FAR)]]):
        flat += [(i, *r) for r in rows]
    df = spark.createDataFrame(flat, "chunk long, seq long, url string, ts timestamp_ntz")
    folder = tempfile.mkdtemp(prefix="late-")
    write_ordered_files(df, folder, len(files) + 1, "chunk")
    s = read_ordered_files(spark, folder, df.schema).drop("chunk")
    return lambda: with_event_time(s, delay=f"{DELAY} seconds")


def shuffled_files(n_files=8, per_file=30, seed=5, step=900, backs=(0, 0, 0, 120, 650, 700, 5000)):
    """Each file holds rows of its own ``step`` seconds and rows some time behind."""
    rng = random.Random(seed)
    files, seq = [], 0
    for i in range(n_files):
        rows = []
        for _ in range(per_file):
            back = rng.choice(backs)
            rows.append((seq, f"/p{rng.choice('aaab')}", T0 + dt.timedelta(seconds=i * step + rng.uniform(0, step) - back)))
            seq += 1
        files.append(rows)
    return files


def as_counts(df):
    return {(r.url, r.window_end): r.cnt for r in df.collect() if r.url != "/flush"}


@pytest.fixture(scope="module")
def replayed(spark):
    files = shuffled_files()
    return files, replay(spark, files), model(files)


def test_every_row_is_counted_or_late_and_never_both(spark, replayed):
    files, source, (counts, late, late_fires) = replayed
    assert all({r[0] for r in rows} & late for rows in files[1:])  # late rows in every file after the first
    assert late_fires > 0
    out = run(stream_windows_with_late(source(), "url", f"{SIZE} seconds", f"{SLIDE} seconds", f"{LATE} seconds", salts=3))
    got = out.filter("channel = 'late'").collect()
    assert {r.seq for r in got} == late and len(got) == len(late)
    by_seq = {r[0]: r for rows in files for r in rows}
    assert all((r.seq, r.url, r.ts) == by_seq[r.seq] for r in got)
    assert as_counts(latest_counts(out.filter("channel = 'fired'"), "url")) == counts


def test_a_late_row_fires_its_windows_again(spark):
    files = shuffled_files(12, 10, seed=2, step=25, backs=(0, 0, 0, 100, 130))
    source, (counts, _, late_fires) = replay(spark, files), model(files)
    out = run(stream_windows_with_late(source(), "url", f"{SIZE} seconds", f"{SLIDE} seconds", f"{LATE} seconds", salts=1))
    firings = defaultdict(list)
    for r in out.filter("channel = 'fired' and url <> '/flush'").collect():
        firings[r.url, r.window_end].append((r.watermark, r.added))
    again = {k: sorted(v) for k, v in firings.items() if len(v) > 1}
    assert again and all(a > 0 for v in firings.values() for _, a in v)
    # a raised count becomes the latest one, later than the first firing
    assert all(v[0][0] < v[1][0] and sum(a for _, a in v) == counts[k] for k, v in again.items())
    assert sum(a for v in again.values() for _, a in v[1:]) <= late_fires


def test_final_counts_and_top_n_chain(spark, replayed):
    _, source, (counts, _, _) = replayed
    final = stream_final_counts(source(), "url", f"{SIZE} seconds", f"{SLIDE} seconds", f"{LATE} seconds", salts=4)
    assert as_counts(run(final)) == counts
    got = {(r.window_end, r["rank"]): (r.url, r.cnt) for r in run(stream_top_n(final, 1, "url")).collect()}
    ends = {e for _, e in counts}
    for e in ends:
        best = min((-n, u) for (u, x), n in counts.items() if x == e)
        at = [v for (w, _), v in got.items() if w.replace(tzinfo=None) == e]
        assert at == [(best[1], -best[0])]


def test_one_row_a_batch_equals_the_batch_operators(spark):
    rng = random.Random(3)
    rows = [(i, "/a" if i % 3 else "/b", T0 + dt.timedelta(seconds=i * 200 - rng.choice([0, 0, 650, 800, 4000])))
            for i in range(14)]
    source = replay(spark, [[r] for r in rows])
    out = run(stream_windows_with_late(source(), "url", f"{SIZE} seconds", f"{SLIDE} seconds", f"{LATE} seconds"))
    df = spark.createDataFrame(rows, "seq long, url string, ts timestamp_ntz")
    args = (f"{SIZE} seconds", f"{SLIDE} seconds", f"{DELAY} seconds", f"{LATE} seconds")
    late = {(r.seq, r.watermark) for r in split_late(df, *args, rows_per_bucket=4).late.collect()}
    assert late and {(r.seq, r.watermark.replace(tzinfo=None)) for r in out.filter("channel = 'late'").collect()} == late
    batch = sliding_count_with_lateness(df, ["url"], *args, rows_per_bucket=4)
    assert as_counts(latest_counts(out.filter("channel = 'fired'"), "url")) == as_counts(batch)
    assert as_counts(batch) == model([[r] for r in rows])[0]


def test_outputs_of_one_query_from_the_command_line(spark, tmp_path):
    files = shuffled_files(4, 10, seed=9)
    flat = [(i, "10.0.0.1", str(s), t, "GET", u, s) for i, rows in enumerate([*files, [(10 ** 6, "/flush", FAR)]])
            for s, u, t in rows]
    df = spark.createDataFrame(flat, "chunk long, ip string, user_id string, ts timestamp_ntz, method string, url string, seq long")
    folder = tempfile.mkdtemp(prefix="log-")
    write_ordered_files(df, folder, 5, "chunk")
    schema = str(tmp_path / "schema")
    df.limit(0).write.parquet(schema + "/access_log.parquet")
    out = str(tmp_path / "out")
    assert main(["stream", "page_windows", "--source", f"access_log={folder}/f*.parquet", "--schema-from", schema,
                 "--out", out, "--checkpoint", str(tmp_path / "ck"), "--max-files", "1", "--once"]) == 0
    counts, late, _ = model(files)
    got = spark.read.parquet(out)
    assert {r.seq for r in got.filter("channel = 'late'").collect()} == late
    assert as_counts(latest_counts(got.filter("channel = 'fired'"), "url")) == counts
