import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import packing
from eventide.llm.common import vocabulary_path, word_encoder
from eventide.llm.queries import QUERIES
from llm_helpers import EDGE, SF_SMALL, make_docs

END = (2).to_bytes(4, "little")


@given(st.lists(st.integers(1, 50), max_size=40), st.integers(50, 80), st.booleans())
@settings(max_examples=200, deadline=None)
def test_blocks_hold_every_token_once(lengths, capacity, cut):
    windows = packing.plan_block(lengths, capacity, cut)
    assert all(sum(n for _, _, n in w) <= capacity for w in windows)
    seen = {i: [] for i in range(len(lengths))}
    for w in windows:
        for i, at, n in w:
            seen[i].append((at, n))
    for i, parts in seen.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at and n > 0
            at += n
        assert at == lengths[i] and (cut or len(parts) == 1)
    if cut:
        assert len(windows) == -(-sum(lengths) // capacity)


def test_differencing_gives_near_equal_windows():
    rng = random.Random(1)
    lengths = [rng.randint(1, 4095) for _ in range(500)]
    sums = [sum(lengths[i] for i in w) for w in packing.difference(lengths, 50)]
    assert sorted(i for w in packing.difference(lengths, 50) for i in w) == list(range(500))
    greedy = [0] * 50
    for n in sorted(lengths, reverse=True):
        greedy[greedy.index(min(greedy))] += n
    assert max(sums) - min(sums) < max(greedy) - min(greedy)
    assert packing.difference([8, 7, 6, 5, 4], 2) and sorted(
        sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2)) == [14, 16]
    assert packing.difference([], 3) == [[], [], []]


def check(rows, texts, capacity):
    encoder = word_encoder(vocabulary_path("word_bpe_49k.json"))
    want = sorted((d is None, d or 0, encoder.encode(t) + END) for d, t in texts)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id is None, r.doc_id or 0), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) // 4 > 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert sum(r.length for r in rows) == sum(len(w[2]) // 4 for w in want)
    for key, pieces in by_doc.items():
        bodies = [w[2] for w in want if w[:2] == key]
        if len(bodies) == 1:
            pieces.sort(key=lambda r: r.start)
            assert b"".join(r.ids for r in pieces) == bodies[0]
            assert all(r.doc_tokens == len(bodies[0]) // 4 for r in pieces)
            assert [r.start for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
    assert set(by_doc) == {w[:2] for w in want}


def test_edge_rows(spark):
    for clash in (False, True):
        for capacity, block in ((64, 4), (4096, 128)):
            out = packing.pack_documents(make_docs(spark, EDGE, clash), capacity=capacity, block_windows=block)
            check(out.collect(), [r[:2] for r in EDGE], capacity)
    assert packing.pack_documents(make_docs(spark, [])).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    pieces = packing.pack_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    check(pieces, docs, 4096)
    out = QUERIES["op8_packing"](spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in out.collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(r.ids) for r in pieces}
    total, size = sum(r.length for r in pieces), {}
    for r in pieces:
        size[r.sequence_id] = size.get(r.sequence_id, 0) + r.length
    assert sum(4096 - n for n in size.values() if n & (n - 1)) < max(4096, 0.02 * total)
