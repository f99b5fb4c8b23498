import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventide.llm import divergence as dv
from llm_helpers import EDGE, make_docs


def brute(rows, min_docs=10, top=10):
    """The contract as plain loops."""
    count, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        count[lang, source].update(words)
        df[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in df[lang].items() if d >= min_docs]
        mine = sorted(s for g, s in groups if g == lang)
        v = len(kept)
        total = {t: sum(count[lang, s][t] for s in mine) for t in kept}

        def share(c, n):
            return 1 + 1000000000 * (c + 2) // (n + 2 * v)

        n = {s: sum(count[lang, s][t] for t in kept) for s in mine}
        p = {s: {t: share(count[lang, s][t], n[s]) for t in kept} for s in mine}
        q = {t: share(total[t], sum(total.values())) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in mine:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in mine if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, i.decode(), -x, r + 1) for r, (x, i) in enumerate(found)]
    return sorted(out)


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"T{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(120)] + ["é", "ÉA", "naïve", "日本", "z"]
    rows = []
    for i in range(260):
        source = rng.choice(["a"] * 8 + ["b", "c", "ç", "d", "e", None])
        words = [rng.choice(vocab[:10 + 12 * (ord((source or "b")[0]) % 7)] + vocab[-5:]) for _ in range(rng.randint(0, 40))]
        rows.append((i, rng.choice([" ", "1", "_[", "\n"]).join(words), rng.choice(["en", "en", "fr", None]), source))
    return rows + [(900, "alone", "xx", "s"), (901, None, "yy", "s"), (902, "", "yy", "t"), (903, "x", "yy", None)]


def got(spark, rows, **kw):
    docs = make_docs(spark, rows, clash=True).repartition(4)
    return sorted(tuple(r) for r in dv.audit_rows(dv.audit(docs, **kw), kw.get("top", 10)).collect())


@pytest.mark.parametrize("sizes", [{}, {"CHUNK": 2, "BLOCK_ROWS": 16, "FLUSH": 5, "FRONTIER": 8}])
def test_audit_equals_plain_loops(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(dv, name, value)
    rows = corpus()
    assert got(spark, rows) == brute(rows)


def test_ties_and_edge_rows(spark):
    same = [(i, "alpha beta gamma delta " * 2, "en", f"s{i % 3}") for i in range(30)]
    rows = same + [(*r, "en", "src")[:4] if len(r) == 2 else r for r in EDGE]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, min_docs=1, top=3) == brute(rows, 1, 3)
    assert got(spark, []) == []


def test_long_text_and_large_counts(spark):
    rows = [(i, "big " * (60_000 if i == 0 else 1) + "ü" * 50_000, "en", f"s{i % 2}") for i in range(10)]
    assert got(spark, rows) == brute(rows)
    # beyond 64 bits inside, exact
    assert dv.shares(np.array([-1, 0, 10**13]), 10**13, 5).tolist() == [
        0, 1 + 2 * 10**9 // (10**13 + 10), 1 + 10**9 * (10**13 + 2) // (10**13 + 10)]


def test_equal_subtrees_are_one_node():
    rng = np.random.default_rng(1)
    counts = np.zeros((6, 1024), np.int64)
    counts[:, :32] = rng.integers(0, 9, (6, 32))
    counts[1] = counts[0]
    counts[5, 900:] = -1
    forest = dv.Forest(counts)
    assert forest.roots[0] == forest.roots[1]
    nodes = sum(len(left) for left, _ in forest.children)
    assert nodes < 6 * 60 < 6 * 1023  # the zeros of all trees share one node a level
    a, b = np.array([0, 0, 2]), np.array([1, 3, 4])
    (j, x, y), total = forest.walk(a, b)
    assert len(j) < 3 * 40  # each pair of leaves met again within a comparison is priced once
    prices = (forest.values[x] - forest.values[y]) ** 2
    assert total(prices).tolist() == [((counts[i] - counts[k]) ** 2).sum() for i, k in zip(a, b)]
