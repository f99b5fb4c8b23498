import random
import re

from eventide.llm import linededup
from eventide.llm.common import WORD_PATTERN
from llm_helpers import CLASH, EDGE, make_docs, sentence


def brute(rows, num=4, den=5):
    """(doc, text) -> text without lines that an earlier line equals or nearly equals."""
    lines = []
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        for i, x in enumerate((t or "").split("\n")):
            w = re.findall(WORD_PATTERN, x)
            if len(w) >= 5:
                lines.append((d, t, i, x, {tuple(w[j:j + 5]) for j in range(len(w) - 4)}))
    first = {}
    for n, (d, t, i, x, s) in enumerate(lines):
        first.setdefault(x, n)
    gone = set()
    for n, (d, t, i, x, s) in enumerate(lines):
        hit = first[x] < n
        for x2, m in first.items():
            s2 = lines[m][4]
            if m < first[x] and den * len(s & s2) >= num * len(s | s2):
                hit = True
                break
        if hit:
            gone.add((d, t, i))
    return {(d, t): None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, t, i) not in gone) for d, t in rows}


def planted(seed):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(5, 60)) for _ in range(12)]
    rows = []
    for d in range(80):
        text = []
        for _ in range(rng.randint(1, 6)):
            w = rng.choice(base).split() if rng.random() < 0.6 else sentence(rng, rng.randint(1, 40)).split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(50)}"
            text.append((rng.choice([" ", "\t"])).join(w) + rng.choice(["", " "]))
        rows.append((d, "\n".join(text)))
    return rows


def test_against_brute_force(spark):
    for seed in range(3):
        rows = planted(seed)
        out = linededup.dedup_lines(make_docs(spark, rows), counts=True).collect()
        want = brute(rows)
        assert {r.doc_id: r.text for r in out} == {d: want[d, t] for d, t in rows}
        for r in out:
            t = dict(rows)[r.doc_id]
            assert r.n_lines == len(t.split("\n"))


def test_passages_across_documents_go_and_clean_documents_stay(spark):
    rng = random.Random(1)
    passage = sentence(rng, 70)
    clean = [(i, "\n".join(sentence(rng, 30) for _ in range(3)) + "\nsee you") for i in range(40)]
    rows = clean[:20] + [(100 + i, sentence(rng, 20) + "\n" + passage + "\nsee you") for i in range(30)] + clean[20:]
    out = {r.doc_id: r.text for r in linededup.dedup_lines(make_docs(spark, rows)).collect()}
    assert all(out[d] == t for d, t in clean)
    assert passage in out[100] and not any(passage in out[100 + i] for i in range(1, 30))


def test_a_large_group_of_near_copies_is_settled_without_all_pairs(spark):
    rng = random.Random(2)
    w = sentence(rng, 60).split()
    rows = [(i, " ".join([*w[:k], f"x{i}", *w[k + 1:]])) for i in range(300) for k in [rng.choice([0, 1, 59])]]
    out = linededup.dedup_lines(make_docs(spark, rows)).collect()
    want = brute(rows)
    assert {r.doc_id: r.text for r in out} == {d: want[d, t] for d, t in rows}


def test_edge_rows(spark):
    docs = make_docs(spark, EDGE, clash=True)
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns and set(CLASH) <= set(out.columns)
    want = brute([r[:2] for r in EDGE])
    got = sorted((str(r.doc_id), str(r.text)) for r in out.collect())
    assert got == sorted((str(d), str(want[d, t])) for d, t, *_ in EDGE)
    assert linededup.dedup_lines(make_docs(spark, []), counts=True).count() == 0


def test_plan_has_no_python(spark):
    plan = linededup.dedup_lines(make_docs(spark, planted(1)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
