import pytest

from conftest import SF_SMALL, rows, ts
from eventide.operators import salted_count, sliding_count, top_n_per_window, tumbling_count
from eventide.sources import Fixtures


@pytest.fixture(scope="module")
def pv(spark):
    return Fixtures(spark, SF_SMALL).user_behavior


@pytest.mark.parametrize("size,slide", [("1 hour", "5 minutes"), ("10 minutes", "1 minute"),
                                        ("1 hour", "30 seconds"), ("2 hours", "1 hour")])
def test_strategies_agree(pv, size, slide):
    base = rows(sliding_count(pv, ["behavior"], size, slide, strategy="direct"))
    assert base
    assert rows(sliding_count(pv, ["behavior"], size, slide, strategy="pane")) == base
    assert rows(sliding_count(pv, ["behavior"], size, slide, strategy="delta")) == base


def test_no_key_and_null_key(spark):
    df = spark.createDataFrame([(None, ts("2024-01-01 00:00:01")), (None, ts("2024-01-01 00:00:07")),
                                ("a", ts("2024-01-01 00:00:02"))], "k string, ts timestamp_ntz")
    for strat in ("direct", "pane", "delta"):
        got = {(r.k, r.window_end, r.cnt)
               for r in sliding_count(df, ["k"], "10 seconds", "5 seconds", strategy=strat).collect()}
        assert got == {(None, ts("2024-01-01 00:00:05"), 1), (None, ts("2024-01-01 00:00:10"), 2),
                       (None, ts("2024-01-01 00:00:15"), 1), ("a", ts("2024-01-01 00:00:05"), 1),
                       ("a", ts("2024-01-01 00:00:10"), 1)}
        total = rows(sliding_count(df, [], "10 seconds", "5 seconds", strategy=strat))
        assert total == [(ts("2024-01-01 00:00:05"), 2), (ts("2024-01-01 00:00:10"), 3),
                         (ts("2024-01-01 00:00:15"), 1)]


def test_salted_equals_plain(pv):
    assert rows(salted_count(pv, ["behavior"], "1 hour")) == rows(tumbling_count(pv, ["behavior"], "1 hour"))


def test_window_end_is_exclusive(spark):
    df = spark.createDataFrame([(ts("2024-01-01 01:00:00"),), (ts("2024-01-01 00:59:59"),)], "ts timestamp_ntz")
    assert rows(tumbling_count(df, [], "1 hour")) == [(ts("2024-01-01 01:00:00"), 1), (ts("2024-01-01 02:00:00"), 1)]


def test_top_n_ties_by_key(spark):
    w = ts("2024-01-01 01:00:00")
    df = spark.createDataFrame([(w, 3, 5), (w, 1, 5), (w, 2, 9), (w, 4, 1)], "window_end timestamp_ntz, item_id int, cnt long")
    got = rows(top_n_per_window(df, 3, "item_id"), "rank", "item_id", "cnt")
    assert got == [(1, 2, 9), (2, 1, 5), (3, 3, 5)]


def test_top_n_plans_partial_limit(pv):
    c = sliding_count(pv.filter("behavior = 'pv'"), ["item_id"], "1 hour", "5 minutes")
    plan = top_n_per_window(c, 5, "item_id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_delta_in_wide_buckets(pv):
    from eventide.operators import windows as W
    base = rows(sliding_count(pv, ["behavior"], "1 hour", "30 seconds", strategy="direct"))
    wide = rows(W._delta(pv, ["behavior"], "ts", "1 hour", "30 seconds", "cnt", bucket="1 day"))
    assert wide == base


def test_small_slides_and_running_visitors_run_no_job_when_called(spark):
    from eventide.plans import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-windows", "queries that are only built")
    try:
        for name in ("marketing_by_channel_profile", "marketing_total_profile", "running_unique_visitors"):
            QUERIES[name](spark, SF_SMALL).schema
        # reading the schema of a Parquet folder is a job of its own, with one task
        stages = [tracker.getJobInfo(j).stageIds for j in tracker.getJobIdsForGroup("lazy-windows")]
        assert all(len(s) == 1 and tracker.getStageInfo(s[0]).numTasks == 1 for s in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
