import math
import random
from collections import Counter

from eventide.llm import quality
from eventide.llm.queries import QUERIES

from llm_helpers import EDGE, SF_SMALL, make_docs, sentence


def brute_repeats(words, width=5):
    windows = [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + j for i, w in enumerate(windows) if w in often for j in range(width)}
    return len(hit)


def test_measures_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        words = [rng.choice("abcde") for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", "\n", "\t", " # "]) for w in words)
        got = dict(zip(quality.MEASURES, quality.measure(text)))
        real = text.split()
        lines = [x for x in text.split("\n") if x.strip()]
        assert got["n_words"] == len(real)
        assert got["word_chars"] == sum(map(len, real))
        assert got["n_symbols"] == text.count("#")
        assert got["n_dup_lines"] == sum(x in lines[:i] for i, x in enumerate(lines))
        assert got["n_repeat_words"] == brute_repeats(real)


def test_binomial_tail_is_exact():
    for n, k, p in ((10, 0, 0.1), (50, 3, 0.05), (400, 9, 0.02), (7, 7, 0.3)):
        want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality.binomial_tail(k, n, p) - want) < 1e-12


def test_certified_stops_at_the_first_failure():
    assert quality.certified([3, 2, 1], [0, 0, 500], 1000, 0.01, 0.01) == 2
    assert quality.certified([3, 2, 1], [500, 0, 0], 1000, 0.01, 0.01) is None
    assert quality.certified([3], [0], 20, 0.01, 0.01) is None  # too few rows to certify anything


def test_false_rejections_stay_below_the_limit_on_fresh_rows():
    rng = random.Random(5)
    bad = 0
    for _ in range(200):
        rates = [0.001, 0.005, 0.02, 0.08]
        seen = [sum(rng.random() < r for _ in range(1500)) for r in rates]
        cut = quality.certified([0, 1, 2, 3], seen, 1500, 0.01, 0.05)
        bad += cut is not None and rates[cut] > 0.01
    assert bad <= 200 * 0.05 + 8


def test_edge_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for docs in (make_docs(spark, EDGE), make_docs(spark, EDGE, clash=True)):
        out = quality.quality_verdicts(docs, labels).collect()
        assert len(out) == len(EDGE)
        by = {r.doc_id: r for r in out if r.doc_id in (1, 2, 3, 7)}
        assert all(by[i].n_words == 0 and by[i].base_failed and not by[i].kept for i in (1, 2, 3))
        assert by[7].n_words == 60000 and by[7].n_repeat_words == 60000 and by[7].base_failed
    assert quality.quality_verdicts(make_docs(spark, []), labels.limit(0)).count() == 0


def test_strict_rules_are_learned_per_stratum(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, 30), "en" if i % 2 else "fr", "s") for i in range(3000)]
    rows += [(10_000 + i, " ".join(w + "###" for w in sentence(rng, 30).split()), "en", "s") for i in range(20)]
    labels = spark.createDataFrame([(r[0], 1 if r[0] < 3000 else 0, 0) for r in rows], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.quality_verdicts(make_docs(spark, rows), labels, alpha=0.1).collect()}
    assert not any(out[10_000 + i].kept for i in range(20))
    assert sum(not out[i].kept for i in range(3000)) <= 300


def test_query(spark):
    df = QUERIES["op1_quality"](spark, SF_SMALL)
    rows = df.collect()
    assert df.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert len(rows) == 200
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
