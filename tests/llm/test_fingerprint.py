import hashlib
import random

import pytest
from pyspark.sql import functions as F

from eventide.llm import fingerprint as fp
from llm_helpers import EDGE, make_docs, sentence


def hashes(text, width=5):
    w = (text or "").encode().split()
    runs = [b" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] or ([b" ".join(w)] if w else [])
    return {hashlib.md5(r).hexdigest()[:16] for r in runs}


def bottom(text, k, width=5):
    return sorted(hashes(text, width))[:k]


def brute(rows, k):
    """Plain loop over the rows in (id, text) order, null ids last."""
    rows = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for j, (i, t) in enumerate(rows):
        nxt = rows[(j + 1) % len(rows)][1]
        cut = len(t) // 4
        ed = t[:len(t) - cut] + nxt[:cut]
        out.append((i, len(t), hashlib.sha256(ed.encode()).hexdigest(), "".join(bottom(t, k)),
                    "".join(bottom(ed, k)), bottom(t, k), bottom(ed, k), bottom(nxt, k)))
    return out


def near(a, b, k):
    u = sorted(set(a) | set(b))[:2 * k if len(a) < k and len(b) < k else k]
    return len(set(a) & set(b) & set(u)) / len(u) if u else 1.0


def corpus():
    rng = random.Random(4)
    rows = [(rng.randrange(-2**62, 2**62), sentence(rng, rng.choice([0, 1, 4, 5, 6, 40, 400]))) for _ in range(300)]
    rows += [(2**53 + i, sentence(rng, 30) + " é\tü\n\n  ß ") for i in range(40)]  # not told apart as doubles
    return rows + [(9, "🙂" * 50 + " a b c d e f g"), (10, "a  b\nc\td e"), (11, "a b c d e")]


@pytest.mark.parametrize("rows", [corpus(), EDGE, [(None, "a b c d e f"), (None, "x")], [(5, "one two")], [(1, "")]])
@pytest.mark.parametrize("k,range_rows", [(128, 2048), (16, 7)])
def test_digest_equals_a_plain_loop(spark, rows, k, range_rows):
    docs = make_docs(spark, rows, clash=True).repartition(3)
    got = fp.fingerprint_digest(fp.edited_texts(docs, k=k, range_rows=range_rows), k=k).collect()
    want = [(i, n, s, f, e, round(near(a, b, k), 9), round(near(a, c, k), 9)) for i, n, s, f, e, a, b, c in brute(rows, k)]
    assert sorted(map(str, want)) == sorted(
        str((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
             round(r.near_next, 9))) for r in got)


def test_empty_table(spark):
    assert fp.fingerprint_digest(fp.edited_texts(make_docs(spark, []))).count() == 0


def test_sketches_of_parts_merge(spark):
    rng = random.Random(8)
    words = sentence(rng, 5000).split()
    whole = " ".join(words)
    # parts overlap by four words, so that no shingle is lost at a seam
    parts = [(i, " ".join(words[i:i + 504]), "all", None) for i in range(0, 5000, 500)] + [(1, None, "all"), (2, "", "none")]
    parts = [(p[0], p[1], p[2], "s") for p in parts]
    d = fp.fingerprints(make_docs(spark, parts))
    got = {r.lang: r.sketch for r in fp.merge_sketches(d, ["lang"]).collect()}
    assert got == {"all": bottom(whole, 128), "none": []}
    two = d.filter("doc_id in (0, 500)").agg(F.collect_list("sketch").alias("s"))
    assert two.select(fp.merge(F.col("s")[0], F.col("s")[1])).first()[0] == bottom(" ".join(words[:1004]), 128)


def test_estimates(spark):
    rng = random.Random(2)
    a = sentence(rng, 6000).split()
    pairs = []
    for share in (0.2, 0.5, 0.8, 1.0):
        keep = int(len(a) * share)
        pairs.append((" ".join(a[:keep]), " ".join(a)))
    df = spark.createDataFrame(pairs, "x string, y string")
    df = df.select("x", "y", fp.sketch(F.col("x")).alias("a"), fp.sketch(F.col("y")).alias("b"))
    for r in df.select("x", "y", fp.resemblance(F.col("a"), F.col("b")).alias("j"),
                       fp.containment(F.col("a"), F.col("b")).alias("c"),
                       fp.containment(F.col("b"), F.col("a")).alias("d"),
                       fp.distinct_shingles(F.col("a")).alias("n")).collect():
        x, y = hashes(r.x), hashes(r.y)
        assert abs(r.j - len(x & y) / len(x | y)) < 0.15
        assert r.c == 1.0 and abs(r.d - len(x & y) / len(y)) < 0.15
        assert abs(r.n / len(x) - 1) < 0.3
    few = spark.createDataFrame([("a b c d e f", "b c d e f g h"), ("", ""), ("a", "")], "x string, y string")
    few = few.select(fp.sketch(F.col("x")).alias("a"), fp.sketch(F.col("y")).alias("b"))
    got = few.select(fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("a"), F.col("b")),
                     fp.distinct_shingles(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(0.25, 0.5, 2.0), (1.0, 1.0, 0.0), (0.0, 0.0, 1.0)]
    back = few.select(fp.parse(fp.fingerprint(F.col("a"))).alias("p"), "a").collect()
    assert all(r.p == r.a for r in back)


def test_plan_is_native(spark):
    docs = make_docs(spark, corpus())
    plan = fp.fingerprint_digest(fp.edited_texts(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "SinglePartition" not in plan
