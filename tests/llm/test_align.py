import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import align
from llm_helpers import EDGE, SF_SMALL, make_docs, sentence


@pytest.fixture(scope="module")
def encoders():
    return align.ByteBpe(align.vocabulary_path(align.A_FILE)), align.Pieces(align.vocabulary_path(align.B_FILE))


def plain_encodings(encoders, texts):
    """Both libraries themselves, one text at a time."""
    a, b = encoders
    return [(a.tokenizer.encode(" " + t, add_special_tokens=False).ids, b.model.encode(t)) for t in texts]


def brute(encoders, rows):
    """The contract as plain loops over bytes."""
    a, b = encoders
    found, held = [], Counter()
    for (_, text, *_r), (x, y) in zip(rows, plain_encodings(encoders, [r[1] or "" for r in rows])):
        x_bytes, y_bytes = (b"".join(s.bytes[i] for i in ids) for s, ids in ((a, x), (b, y)))
        if not text or x_bytes != (" " + text).encode() or y_bytes != x_bytes:
            found.append(None)
            continue
        ends = [set(np.cumsum([len(s.bytes[i]) for i in ids]).tolist()) for s, ids in ((a, x), (b, y))]
        sides = []
        for s, ids in ((a, x), (b, y)):
            groups, at = [[]], 0
            for i in ids:
                groups[-1].append(i)
                at += len(s.bytes[i])
                if at in ends[0] and at in ends[1]:
                    groups.append([])
            sides.append(groups[:-1])
        links = Counter((p, q) for g, h in zip(*sides) for p in g for q in h)
        found.append((len(x), len(y), list(zip(*sides)), links))
        held.update(links.keys())
    top = defaultdict(int)
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    out = []
    for (i, *_), f in zip(rows, found):
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        shown = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((i, n_a, n_b, len(groups), sum(links.values()), sum(m for (p, q), m in links.items() if held[p, q] == top[p]),
                    sum(m * held[k] for k, m in links.items()), hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(map(str, out)), held, top


def got(spark, rows, held=None):
    docs = make_docs(spark, rows, clash=True).repartition(3)
    digest, pairs = align.align_corpus(docs, held=held)
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(str(tuple(r)) for r in digest.select(*cols).collect()), pairs


def corpus():
    rng = random.Random(6)
    words = ["tokenization", "Ünïcode", "日本語", "🙂🙂", "<|endoftext|>", "</s>", "<unk>", "it's", "a", ",", "x1y2", " ",
             "don't", "\t", "\n\n", "  ", "ﬁ", "é", "▁", "ZZZZzzzz", "1234567", "\x00", "​"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 30)))) for i in range(200)]
    rows += [(500 + i, sentence(rng, 60)) for i in range(60)]
    return rows + [(700, "a" * 3000 + " b" * 400), (701, "=" * 2500), (702, " "), (703, "\n"), (704, "é" * 40)]


@pytest.mark.parametrize("held", [None, 50, 0])
def test_alignment_equals_plain_loops(spark, encoders, held):
    rows = corpus() + EDGE
    want, counts, top = brute(encoders, rows)
    digest, pairs = got(spark, rows, held)
    assert digest == want
    assert {(r.a, r.b): (r.docs, r.best) for r in pairs.collect()} == {
        (a, b): (n, n == top[a]) for (a, b), n in counts.items()}


def test_memo_starts_afresh(encoders, monkeypatch):
    monkeypatch.setattr(align, "MEMO", 20)
    small = align.Aligner(align.vocabulary_path(align.A_FILE), align.vocabulary_path(align.B_FILE))
    texts = [t or "" for _, t, *_ in corpus()]
    one = [f for t in texts for f in small.align_all([t])]
    monkeypatch.setattr(align, "MEMO", 10**6)
    large = align.Aligner(align.vocabulary_path(align.A_FILE), align.vocabulary_path(align.B_FILE))
    all_ = large.align_all(texts)
    assert [f[:5] for f in one] == [f[:5] for f in all_]
    assert all((f.codes == g.codes).all() and (f.links == g.links).all() for f, g in zip(one, all_))
    seen = len(large.shown)
    large.align_all(texts)
    assert len(large.shown) == seen and len(small) < 200  # nothing is aligned twice; the small one forgot


def test_windows_end_where_both_tokens_end(encoders):
    a, b = encoders
    worker = align.Aligner(align.vocabulary_path(align.A_FILE), align.vocabulary_path(align.B_FILE))
    text = "the cat's  pyjamas\nwere unbelievably (un)comfortable "
    [(x, y)] = plain_encodings(encoders, [text])
    keys, starts = worker.windows(np.array(x), np.array(y))
    ids = [np.frombuffer(k, np.uint32).tolist() for k in keys]
    sides = [[b"".join(a.bytes[i] for i in k if i < align.B_SIDE) for k in ids],
             [b"".join(b.bytes[i - align.B_SIDE] for i in k if i >= align.B_SIDE) for k in ids]]
    assert sides[0] == sides[1] and b"".join(sides[0]).decode() == " " + text
    assert all(w.startswith(b" ") for w in sides[0]) and len(keys) > 5


def test_fast_encoder_equals_the_tokenizers_library(encoders):
    rng = random.Random(11)
    a, _ = encoders
    pool = [chr(c) for c in range(0x250)] + list("etaoin shrdlu 's.,'") * 20 + ["<|endoftext|>", "'ll", "  ", "\n", "\r\n"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 80))) for _ in range(5000)]
    assert a.fast is not None and all(map(a.is_plain, texts))
    assert a.encode(texts) == [e.ids for e in a.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert not a.is_plain("日本") and not a.is_plain("x" * 500) and not a.is_plain(" " * 3000)


def test_real_documents_and_empty_table(spark, encoders):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    digest, _ = align.align_corpus(docs)
    assert sorted(str(tuple(r)) for r in digest.collect()) == brute(encoders, rows)[0]
    assert align.align_corpus(make_docs(spark, []))[0].count() == 0
    assert align.align_corpus(make_docs(spark, [(1, None), (2, "")]))[0].agg(F.sum("n_links")).first()[0] == 0
