import random

import numpy as np

from eventide.llm import toxicity
from llm_helpers import make_docs, sentence
from test_toxicity import LABELS, planted


def test_long_texts_set_no_features_they_do_not_have(spark):
    rows, labels = planted()
    model = toxicity.train(make_docs(spark, rows), spark.createDataFrame(labels, LABELS))
    rng = random.Random(9)
    foreign = "".join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(400_000))
    flags = np.zeros(len(model.weights), np.float32)
    plain = toxicity.score_text(model, "一", flags)
    assert toxicity.score_text(model, foreign, flags) == plain


def test_rare_toxic_wording_carries_weight(spark):
    rng = random.Random(10)
    bad = ["".join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(3)) for _ in range(800)]
    rows, labels = [], []
    for i, w in enumerate(bad):
        for k in range(3):  # each word is in three toxic training texts only
            rows.append((len(rows), sentence(rng, 30) + f" {w} " + sentence(rng, 10)))
            labels.append((len(labels), 1, 1))
    for _ in range(10_000):
        rows.append((len(rows), sentence(rng, 41)))
        labels.append((len(labels), 1, 0))
    new = [(100_000 + i, sentence(rng, 30) + f" {w} " + sentence(rng, 10)) for i, w in enumerate(bad)]
    model = toxicity.train(make_docs(spark, rows), spark.createDataFrame(labels, LABELS))
    score = [r.score for r in toxicity.score_documents(make_docs(spark, new), model).collect()]
    clean = [r.score for r in toxicity.score_documents(make_docs(spark, [(i, sentence(rng, 41)) for i in range(300)]), model).collect()]
    assert np.mean([s >= 0.3 for s in score]) > 0.99
    assert np.mean([s >= 0.3 for s in clean]) < 0.05
