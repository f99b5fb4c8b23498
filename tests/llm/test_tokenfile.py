import io
import random
import zlib

import pytest
import zstandard
from tokenizers import Tokenizer

from eventide.llm import tokenfile
from eventide.llm.common import shared_dir, vocabulary_path
from eventide.llm.queries import QUERIES

from llm_helpers import EDGE, SF_SMALL, make_docs

TOKENIZER = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))


def raw(text):
    return b"".join(i.to_bytes(4, "little") for i in [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2])


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def written(docs, frame_tokens):
    out = io.BytesIO()
    w = tokenfile.FrameWriter(out, frame_tokens, 3)
    for i, ids in docs:
        w.add(i, ids)
    w.close()
    return out.getvalue()


def test_random_access_opens_only_needed_frames():
    rng = random.Random(3)
    docs = [(i, rng.randbytes(4 * rng.randint(1, 60))) for i in range(300)]
    data = written(docs, 64)
    for i in (0, 17, 299):
        r = tokenfile.FrameReader(Source(data))
        assert r.document(i) == docs[i][1]
        assert r.decompressed <= len(docs[i][1]) // (4 * 64) + 2
    r = tokenfile.FrameReader(Source(data))
    assert [r.document(i) for i in range(300)] == [d for _, d in docs]
    assert r.decompressed == len(r.sizes)  # each frame once when read in order


def test_any_zstandard_tool_reads_the_ids():
    docs = [(1, b"\1\0\0\0" * 10), (None, b"\2\0\0\0" * 300)]
    data = written(docs, 64)
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == docs[0][1] + docs[1][1]


def test_damage_is_found():
    data = bytearray(written([(1, bytes(range(256)) * 40)], 1 << 16))
    r = tokenfile.FrameReader(Source(bytes(data)))
    r.sums = r.sums ^ 1
    with pytest.raises(ValueError):
        r.document(0)
    with pytest.raises(ValueError):
        tokenfile.FrameReader(Source(bytes(data[:-1])))


def test_edge_rows_and_chosen_documents(spark):
    folder = shared_dir(spark, "test-tokens")
    tokenfile.write_tokens(make_docs(spark, EDGE, clash=True), folder, files=3, frame_tokens=64)
    out = sorted(tokenfile.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in out) == sorted(
        (d[0] is None, d[0] or 0, raw(d[1])) for d in EDGE)
    at = 0
    for r in out:
        assert r.start == at and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
    ids = [r.doc_id for r in out]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    some = tokenfile.read_tokens(spark, folder, doc_ids=[4, 7]).collect()
    assert sorted(r.doc_id for r in some) == [4, 4, 7]
    empty = shared_dir(spark, "test-tokens")
    tokenfile.write_tokens(make_docs(spark, []), empty)
    assert tokenfile.read_tokens(spark, empty).count() == 0


def test_query_against_the_tokenizer(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    at = 0
    for r in sorted(QUERIES["op2_token_files"](spark, SF_SMALL).collect(), key=lambda r: r.doc_id):
        want = raw(texts[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want) // 4, zlib.crc32(want))
        at += r.n_tokens
