import numpy as np

from eventide.llm import topk
from llm_helpers import CLASH
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, is_query):
    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        ok.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    out = []
    for i, q in sorted({(i, tuple(v)) for i, v in ok}):
        if is_query(i):
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)
            out += [(i, r + 1, j, -s_) for r, (s_, j) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, k=10, clash=False, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    if clash:
        df = df.withColumns({c: F.lit(1) for c in [*CLASH, "norm", "ints", "dims", "chunk", "query_id"]})
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=k, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def test_against_brute_force_with_ties_and_uneven_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 10 ** rng.uniform(-1, 1), 6).round(1)]) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0]) for i in range(30)]  # one very common vector
    assert run(spark, rows, k=4, block=16, chunk_mb=1) == brute(rows, 4, lambda i: i % 5 == 0)


def test_edge_rows(spark):
    rows = [(0, [1.0, -1.0]), (5, None), (10, [None, 1.0]), (15, [float("nan"), 1.0]), (20, [float("inf"), 0.0]),
            (1, [0.5]), (2, []), (3, [1.0, 1.0, 1.0]), (3, [1.0, 1.0, 1.0]), (None, [1.0]), (25, []), (0, [1.0, -1.0])]
    assert run(spark, rows, clash=True) == brute(rows, 10, lambda i: i % 5 == 0)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == [] and run(spark, [(5, None)]) == []


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(1)
    x = (rng.normal(0, 1, (4000, 16)) * np.exp(rng.normal(0, 1, (4000, 1))) * 1024).astype(np.int64)
    x = x[np.argsort(-(x.astype(float) ** 2).sum(1), kind="stable")]
    ids, q = np.arange(4000), x[::400]
    _, axes = np.linalg.eigh((x.astype(float)).T @ x)
    s = topk.Search(-1 - np.arange(10), q, axes[:, ::-1], 5, 4)
    for at in range(0, 4000, 100):
        b = x[at:at + 100]
        s.block(ids[at:at + 100], b, float(np.sqrt((b.astype(float) ** 2).sum(1)).max()))
    assert s.scored < 0.5 * 10 * 4000
    for i in range(10):
        want = sorted(zip(-(x @ q[i]), ids))[:5]
        mine = s.best[0] == i
        assert [(-a, b) for a, b in zip(s.best[1][mine], s.best[2][mine])] == want


def test_large_components(spark):
    """Sums beyond 2^53 and products beyond 2^63 inside; scores that fit are exact, others are an error."""
    import pytest
    big = 2.0 ** 31 / 1024
    rows = [(0, [big, -big, 1.0]), (1, [big, big, 2.0]), (2, [big, big * 0.5, 0.0]), (3, [-big, big, 0.0]), (4, [0.0, 0.0, 3.0]),
            (5, [big, big, 0.0]), (6, [1e14, 1e14, 1.0]), (7, [-1e14, -1e14, 0.0])]
    wide = spark.createDataFrame([(i, v) for i, v in rows[:5]], "vec_id long, embedding array<double>")
    got = topk.top_k(wide, F.col("vec_id") == 0, k=4).collect()
    want = sorted((-sum(int(a * 1024) * int(b * 1024) for a, b in zip(rows[0][1], v)), i) for i, v in rows[1:5])
    assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == want
    # a score near -2^64 is only wrong if it is returned
    wide = spark.createDataFrame(rows[4:5] + rows[5:6] + [(8, [-big * 2, -big * 2, 0.0]), (9, [1.0, 1.0, 1.0])],
                                 "vec_id long, embedding array<double>")
    got = topk.top_k(wide, F.col("vec_id") == 5, k=2).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(1, 9), (2, 4)]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(spark.createDataFrame(rows[5:7], "vec_id long, embedding array<double>"), F.col("vec_id") == 5).collect()
