import random

from eventide.llm import linededup
from llm_helpers import make_docs, sentence
from test_linededup import brute


def edited(rng, words, edits):
    out = list(words)
    for k in rng.sample(range(len(out)), edits):
        out[k] = f"own{rng.randrange(10 ** 9)}"
    return " ".join(out)


def test_candidates_of_a_large_group_grow_with_its_lines(spark, monkeypatch):
    """Copies of a base that are each too far from all others, some close ones, and copies of copies."""
    rng, pairs, real = random.Random(4), [], linededup.materialize

    def counting(df, name):
        out = real(df, name)
        if name == "line-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(linededup, "materialize", counting)
    base = sentence(rng, 60).split()
    texts = [edited(rng, base, rng.choice([1, 2, 2, 2, 3])) for _ in range(300)]
    texts += [edited(rng, rng.choice(texts).split(), 1) for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    out = {r.doc_id: r.text for r in linededup.dedup_lines(make_docs(spark, rows)).collect()}
    want = brute(rows)
    assert out == {d: want[d, t] for d, t in rows}
    assert 30 < sum(t == "" for t in out.values()) < 330
    assert sum(pairs) < 10 * len(rows)  # all pairs: 64,620


def test_other_thresholds(spark):
    rng = random.Random(5)
    for num, den in ((1, 2), (7, 10), (9, 10), (1, 1)):
        base = [sentence(rng, rng.randint(5, 50)).split() for _ in range(3)]
        rows = []
        for d in range(70):
            w = rng.choice(base)
            rows.append((d, edited(rng, w, rng.randint(0, min(5, len(w))))))
        out = {r.doc_id: r.text for r in linededup.dedup_lines(make_docs(spark, rows), num=num, den=den).collect()}
        want = brute(rows, num, den)
        assert out == {d: want[d, t] for d, t in rows}
