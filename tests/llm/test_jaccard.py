import random

import numpy as np

from eventide.llm import jaccard
from eventide.llm.components import components
from llm_helpers import EDGE, make_docs, sentence


def shingle_set(t):
    w = (t or "").encode().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    out = []
    for i, (d, t) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        own = [x for x in own if x is not None]
        out.append((d, min(own) if own else None, links[i]))
    return sorted(map(str, out))


def planted(seed, n=150):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(3, 120)) for _ in range(25)]
    rows = []
    for d in range(n):
        w = rng.choice(base).split() if rng.random() < 0.8 else sentence(rng, rng.randint(1, 90)).split()
        for _ in range(rng.choice([0, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
        rows.append((d, " ".join(w)))
    return rows


def got(spark, rows, **options):
    df = jaccard.near_copy_classes(make_docs(spark, rows), **options)
    return sorted(str((r.doc_id, r.class_id, r.n_links)) for r in df.collect())


def test_against_brute_force_also_with_tiny_blocks(spark):
    for seed, block in ((1, 256), (2, 3)):
        rows = planted(seed)
        assert got(spark, rows, block=block) == brute(rows)


def test_recall_of_runs():
    assert jaccard.runs_for(0.9999, 0.8, 3) == 13
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(400):
        both = rng.integers(0, 2 ** 63, 88, dtype=np.uint64)
        a = np.sort(np.concatenate([both, rng.integers(0, 2 ** 63, 11, dtype=np.uint64)]))
        b = np.sort(np.concatenate([both, rng.integers(0, 2 ** 63, 11, dtype=np.uint64)]))
        met += (jaccard.paths(a, 13, 3, 7) == jaccard.paths(b, 13, 3, 7)).any()
    assert met >= 398
    assert (jaccard.paths(a, 13, 3, 7) == jaccard.paths(a, 13, 3, 7)).all()


def test_edge_rows(spark):
    rows = [r[:2] for r in EDGE]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    docs = make_docs(spark, EDGE, clash=True)
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    texts = sorted(str((r.doc_id, r.text)) for r in kept.collect())
    want = list(rows)
    want.remove((4, "a b c"))
    assert texts == sorted(str(r) for r in want)


def test_one_document_of_each_class_stays(spark):
    rows = planted(3)
    classes = {}
    for r in jaccard.near_copy_classes(make_docs(spark, rows)).collect():
        classes.setdefault(r.class_id, []).append(r.doc_id)
    kept = {r.doc_id for r in jaccard.drop_near_copies(make_docs(spark, rows)).collect()}
    assert kept == {min(c) for c in classes.values()} == set(classes)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (103, 103)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 103: 103}
