import random
import zlib

import numpy as np

from eventide.llm import toxicity
from eventide.llm.queries import QUERIES
from llm_helpers import EDGE, SF_MID, make_docs, sentence
from pyspark.sql import functions as F


def test_buckets_cover_the_whole_text():
    text = "ab" * 3 + "  C\n" + "x" * 10
    joined = " " + " ".join(text.lower().split()) + " "
    want = sum(len(joined) - n + 1 for n in (3, 4, 5))
    assert sum(len(x) for x in toxicity.buckets(text, 18)) == want
    old, toxicity.CHUNK = toxicity.CHUNK, 7
    try:
        small = np.sort(np.concatenate(list(toxicity.buckets(text, 18))))
    finally:
        toxicity.CHUNK = old
    assert (small == np.sort(np.concatenate(list(toxicity.buckets(text, 18))))).all()
    assert sum(len(x) for x in toxicity.buckets("", 18)) == 0


def test_logistic_fit_reaches_a_small_gradient():
    rng = np.random.default_rng(1)
    rows = [np.flatnonzero(rng.random(20) < 0.4).astype(np.uint16) for _ in range(300)]
    ratio = rng.normal(0, 1, 20)
    y = np.array([float(3 in r) for r in rows])
    w, b = toxicity.fit_logistic(rows, y, np.ones(300), ratio, 1e-3, steps=400, chunk=37)
    p = np.array([1 / (1 + np.exp(-((w * ratio)[r].sum() + b))) for r in rows])
    assert ((p > 0.5) == (y > 0)).mean() > 0.98


def planted(n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = sentence(rng, rng.randint(5, 80)) + (" you utter nincompoop" if bad else "")
        rows.append((i, text))
        labels.append((i, 1, int(bad)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_learns_planted_words_and_keeps_clean_rows(spark):
    rows, labels = planted()
    docs = make_docs(spark, rows, clash=True)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS), F.col("doc_id") % 2 == 0)
    score = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    odd = [i for i in range(600) if i % 2]
    assert np.mean([(score[i] >= 0.3) == (i % 5 == 0) for i in odd]) > 0.97
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i in range(600) if score[i] < 0.3}
    again = toxicity.train(docs, spark.createDataFrame(labels, LABELS), F.col("doc_id") % 2 == 0)
    assert np.array_equal(model.weights, again.weights)


def test_edge_rows(spark):
    rows, labels = planted(100)
    more = [(1001, None, 1), (None, 1, 1), (7, 1, None), (3, 0, 0), (3, 0, 0)]
    docs = make_docs(spark, rows + EDGE)
    lab = spark.createDataFrame(labels + more, LABELS)
    model = toxicity.train(docs, lab)
    out = toxicity.score_documents(make_docs(spark, EDGE), model).collect()
    assert len(out) == len(EDGE) and all(0 <= r.score <= 1 for r in out)
    empty = {round(r.score, 9) for r in out if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    for only, low in ((0, True), (1, False)):
        model = toxicity.train(docs, lab.filter(F.col("toxic") == only))
        scores = [r.score for r in toxicity.score_documents(docs, model).collect()]
        assert all((s < 0.3) == low for s in scores)
    assert toxicity.score_documents(make_docs(spark, []), toxicity.train(make_docs(spark, []), lab.limit(0))).count() == 0


def test_query_on_held_out_rows(spark):
    out = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, SF_MID).collect()}
    assert len(out) == 1000
    lab = [r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()]
    held = [r for r in lab if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(out[r.doc_id].held_out for r in held) and not any(out[r.doc_id].held_out for r in lab if r not in held)
    assert np.mean([out[r.doc_id].predicted == r.toxic for r in held]) > 0.85  # 37 toxic rows to learn from
    assert all(r.predicted == int(r.score >= 0.3) for r in out.values())
