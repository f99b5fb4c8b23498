import random
import re

import numpy as np
import pytest

from eventide.llm import mixing
from eventide.llm.common import WORD_PATTERN
from llm_helpers import EDGE, make_docs, sentence


def fill(sizes, weights, epochs):
    """The loop itself: clamp what is above its cap, reshare the rest by weight, until nothing is above."""
    open_, target, left = set(range(len(sizes))), [0.0] * len(sizes), float(sum(sizes))
    while True:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > epochs * sizes[i]]
        if not over:
            return [left * weights[i] / total if i in open_ else target[i] for i in range(len(sizes))]
        for i in over:
            target[i] = float(epochs * sizes[i])
            open_.discard(i)
        left = sum(sizes) - sum(target[i] for i in range(len(sizes)) if i not in open_)


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_the_loop(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 100, 5000]) * rng.randint(1, 9) for _ in range(17)]
    names = [f"s{i:02d}" for i in range(16)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.fill_targets(df).collect()}
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(17)], 3)
    assert np.allclose([got[n] for n in names], want)


def corpus():
    rng = random.Random(9)
    rows = [(i, sentence(rng, rng.randint(0, 60)), "en", rng.choice(["a", "a", "a", "b", "é", None])) for i in range(400)]
    return rows + [(i, "big " * 3000, "en", "b") for i in (900, 901)]


def test_words_taken(spark):
    docs = make_docs(spark, corpus(), clash=True)
    rows = mixing.mix_plan_rows(mixing.plan_mix(docs)).collect()
    assert len(rows) == 402 and rows and sorted(map(str, rows)) == sorted(map(str, mixing.mix_plan_rows(mixing.plan_mix(docs)).collect()))
    source = {r[0]: r[3] for r in corpus()}
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in taken)
    out = mixing.sample_mix(docs)
    assert out.columns == docs.columns
    words = {}
    texts = {r[0]: r[1] for r in corpus()}
    for r in out.collect():
        n = len(re.findall(WORD_PATTERN, r.text))
        assert texts[r.doc_id].startswith(r.text) and n > 0
        words[r.doc_id] = words.get(r.doc_id, 0) + n
    assert words == {r.doc_id: r.taken for r in rows if r.taken}


def test_edge_rows(spark):
    docs = make_docs(spark, EDGE, clash=True)
    rows = mixing.mix_plan_rows(mixing.plan_mix(docs)).collect()
    assert len(rows) == len(EDGE)
    assert all(r.taken == 0 for r in rows if r.size == 0) and all(r.taken <= 3 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id == 7} == {60000}
    got = mixing.sample_mix(docs).collect()
    assert all(r.text for r in got)
    assert mixing.mix_plan_rows(mixing.plan_mix(make_docs(spark, []))).count() == 0
    assert mixing.sample_mix(make_docs(spark, [])).count() == 0
    blank = make_docs(spark, [(1, None), (2, "")])
    assert [r.taken for r in mixing.mix_plan_rows(mixing.plan_mix(blank)).collect()] == [0, 0]
