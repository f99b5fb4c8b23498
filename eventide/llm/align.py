"""Operator 12: alignment of two tokenizers' ids on the same text.

Both tokenizers encode the whole text.  Where a token of each ends at the same byte and the next token of each
begins with a space, the text is cut: every such anchor is checked on the byte offsets, never assumed.  The windows
between anchors, mostly single words, are pairs of id tuples, and their alignment is memoised by that pair: a worker
aligns a word once.  Inside a window, bytes where tokens of both end cut it into groups; all A ids of a group are
linked to all its B ids.

Corpus-wide, an id pair counts in how many documents it is linked; ``best`` marks the pairs whose count is the highest
of their A id.

Scale: one pass encodes and aligns, and writes a narrow table of counts and distinct linked pairs per document.  Pair
counts are partial aggregates of it.  Per-document sums look up the ``HELD`` most frequent pairs at most (a broadcast
table of proven size); pairs beyond them are joined by a shuffle to the full table of pairs, so results do not depend
on how many are held.  A group of A ids with one another's B ids is kept as distinct ids with multiplicities, and a
worker's memo starts afresh beyond ``MEMO`` windows, so memory is bounded by the longest text.

Defined cases: null or empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens:
zeros and an empty digest; repeated rows count as documents of their own; null ids stay; an empty table gives no
rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import _byte_chars, materialize, vocabulary_path, worker_cache

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Windows, and bytes of windows, a worker remembers.
MEMO, MEMO_BYTES = 300_000, 1 << 25
#: Pairs in the broadcast table.
HELD = 1 << 20
CHUNK_CHARS = 1 << 18
B_SIDE = 1 << 31


class ByteBpe:
    """Ids of space + text by a byte-level BPE file.

    A plain file of this kind (merges in id order, the usual word pattern) is also run by tiktoken, several times
    faster, on texts of Latin letters without overlong words, where both libraries' character classes agree; all
    else goes through the tokenizers library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in _byte_chars().items()}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        vocab = spec["model"]["vocab"]
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in ranks.items():
            self.bytes[i] = t
        self.fast = self._fast(spec, ranks)

    @staticmethod
    def _fast(spec, ranks):
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        vocab, first = spec["model"]["vocab"], 256
        split = spec.get("pre_tokenizer") or {}
        if (spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
                or not split.get("use_regex", True) or any(vocab[x + y] != first + i for i, (x, y) in enumerate(merges))):
            return None
        try:
            import public_tokenizers
            import tiktoken
            return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={})
        except ImportError:
            return None

    def gives(self, ids: list[int], plain: bytes) -> bool:
        """Whether the ids' bytes are the text: so by construction where bytes alone are merged, else compared."""
        return self.fast is not None or b"".join(map(self.bytes.__getitem__, ids)) == plain

    @staticmethod
    def is_plain(text: str) -> bool:
        if not text.isascii() and max(text) > "ɏ":
            return False
        words = text.split()
        return len(max(words, key=len, default="")) < 400 and len(text) < 3 * sum(map(len, words)) + 400

    def encode(self, texts: list[str]) -> list[list[int]]:
        out, slow = [None] * len(texts), []
        for i, text in enumerate(texts):
            if self.fast is not None and self.is_plain(text):
                out[i] = self.fast.encode_ordinary(" " + text)
            else:
                slow.append(i)
        if slow:
            for i, e in zip(slow, self.tokenizer.encode_batch([" " + texts[i] for i in slow], add_special_tokens=False)):
                out[i] = e.ids
        return out


class Pieces:
    """Ids of a text by a sentencepiece model, which puts the space in front itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i in range(self.model.vocab_size()) for p in [self.model.id_to_piece(i)]]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


class Alignment(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    digest: str
    codes: np.ndarray  # distinct linked pairs, a * |B| + b, ascending
    links: np.ndarray  # how often each is linked


_NONE = Alignment(0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))


class _Column:
    """An int64 array that grows."""

    def __init__(self):
        self._all, self.n = np.empty(1024, np.int64), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self._all):
            self._all = np.concatenate([self.values, np.empty(self.n + len(values) + 1024, np.int64)])
        self._all[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self._all[:self.n]


class Aligner(dict):
    """Memo of window alignments: the ids of a window -> its number in the tables below.

    The tuple of a window's A ids and then its B ids, these with the top bit set, is held as bytes.
    """

    def __init__(self, a_path: str, b_path: str):
        super().__init__()
        self.a, self.b = ByteBpe(a_path), Pieces(b_path)
        self.a_len, self.b_len = (np.array([len(t) for t in s.bytes], np.int64) for s in (self.a, self.b))
        self.a_space, self.b_space = (np.array([t[:1] == b" " for t in s.bytes]) for s in (self.a, self.b))
        # an id as it is shown inside and at the end of its side of a group: all of A, then all of B
        self.names = [b"%d%c" % (i, c) for s, last in ((self.a, b"|"), (self.b, b";"))
                      for i in range(len(s.bytes)) for c in (b",", last)]
        self.name_len = np.array([len(n) for n in self.names], np.int64)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.shown, self.held = [], 0
        self.groups, self.links, self.pair_from, self.codes, self.times = (_Column() for _ in range(5))

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Id windows between the anchors of two encodings of the same bytes, and where each begins in ``a``."""
        a_end, b_end = self.a_len[a].cumsum(), self.b_len[b].cumsum()
        a_at = np.zeros(a_end[-1] + 1, np.int64)  # how many A tokens end up to a byte at which one ends before a space
        a_cut = np.flatnonzero(self.a_space[a[1:]])
        a_at[a_end[a_cut]] = a_cut + 1
        b_cut = np.flatnonzero(self.b_space[b[1:]])
        shared = a_at[b_end[b_cut]]
        both = shared > 0
        starts = np.concatenate([[0], shared[both]])
        b_starts = np.concatenate([[0], b_cut[both] + 1])
        a_n, b_n = np.diff(starts, append=len(a)), np.diff(b_starts, append=len(b))
        ids = np.empty(len(a) + len(b), np.uint32)
        ids[np.arange(len(a)) + np.repeat(b_starts, a_n)] = a
        ids[np.arange(len(b)) + np.repeat(starts + a_n, b_n)] = b | B_SIDE
        data, at = ids.tobytes(), [*((starts + b_starts) * 4).tolist(), len(ids) * 4]
        return [data[i:k] for i, k in zip(at, at[1:])], starts

    def learn(self, keys: list[bytes]) -> None:
        """Align new windows, laid end to end: their ends are shared ends, so no group crosses them."""
        ids = np.frombuffer(b"".join(keys), np.uint32).astype(np.int64)
        of_b = ids >= B_SIDE
        a, b = ids[~of_b], ids[of_b] - B_SIDE
        n_all = np.array([len(k) // 4 for k in keys])
        n_b = np.add.reduceat(of_b, n_all.cumsum() - n_all, dtype=np.int64)
        n_a = n_all - n_b
        a_end, b_end = self.a_len[a].cumsum(), self.b_len[b].cumsum()
        ends_a, ends_b = np.zeros((2, a_end[-1] + 1), bool)
        ends_a[a_end], ends_b[b_end] = True, True
        a_last, b_last = ends_b[a_end], ends_a[b_end]  # the last token of a group on either side
        a_group, b_group = a_last.cumsum() - a_last, b_last.cumsum() - b_last
        na, nb = np.bincount(a_group), np.bincount(b_group)
        a_from, b_from = na.cumsum() - na, nb.cumsum() - nb
        group_end = a_group[n_a.cumsum() - 1] + 1
        n_groups = np.diff(group_end, prepend=0)
        window = np.repeat(np.arange(len(keys)), n_groups)
        size = na * nb
        n_links = np.add.reduceat(size, group_end - n_groups)
        # every link of the small groups; of large ones distinct ids with their multiplicities
        small = np.where(size <= 64, size, 0)
        g = np.repeat(np.arange(len(size)), small)
        at = np.arange(len(g)) - np.repeat(small.cumsum() - small, small)
        code = [a[a_from[g] + at // nb[g]] * len(self.b_len) + b[b_from[g] + at % nb[g]]]
        owner, times = [window[g]], [np.ones(len(g), np.int64)]
        for h in np.flatnonzero(size > 64):
            x, m = np.unique(a[a_from[h]:a_from[h] + na[h]], return_counts=True)
            y, n = np.unique(b[b_from[h]:b_from[h] + nb[h]], return_counts=True)
            code.append((x[:, None] * len(self.b_len) + y).ravel())
            times.append((m[:, None] * n).ravel())
            owner.append(np.full(len(code[-1]), window[h]))
        code, owner, times = map(np.concatenate, (code, owner, times))
        order = np.lexsort((code, owner))
        code, owner = code[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])]))
        times = np.add.reduceat(times[order], first)
        n_pairs = np.bincount(owner[first], minlength=len(keys))
        # ids as text: A side, then B side of each group
        side = np.concatenate([2 * a_group, 2 * b_group + 1]).argsort(kind="stable")
        name = np.concatenate([2 * a + a_last, 2 * (len(self.a_len) + b) + b_last])[side]
        text = b"".join(map(self.names.__getitem__, name.tolist()))
        text_end = self.name_len[name].cumsum()[(n_a + n_b).cumsum() - 1].tolist()
        base = len(self.shown)
        self.shown += [text[i:k - 1] for i, k in zip([0, *text_end], text_end)]
        self.pair_from.add(self.codes.n + n_pairs.cumsum() - n_pairs)
        self.groups.add(n_groups)
        self.links.add(n_links)
        self.codes.add(code[first])
        self.times.add(times)
        self.held += 4 * (len(a) + len(b))
        self.update(zip(keys, range(base, base + len(keys))))

    def align_all(self, texts: list[str]) -> list[Alignment]:
        out, whole = [_NONE] * len(texts), []
        for i, (text, a_ids, b_ids) in enumerate(zip(texts, self.a.encode(texts), self.b.encode(texts))):
            plain = b" " + text.encode("utf-8", "surrogatepass")
            if text and self.a.gives(a_ids, plain) and b"".join(map(self.b.bytes.__getitem__, b_ids)) == plain:
                whole.append((i, np.array(a_ids), np.array(b_ids)))
        if not whole:
            return out
        if len(self) > MEMO or self.held > MEMO_BYTES:
            self.forget()
        # every text begins with a space, so texts laid end to end are cut at their own starts
        keys, starts = self.windows(np.concatenate([a for _, a, _ in whole]), np.concatenate([b for _, _, b in whole]))
        numbers = list(map(self.get, keys))
        unknown = [i for i, n in enumerate(numbers) if n is None]
        if unknown:
            self.learn(list(dict.fromkeys([keys[i] for i in unknown])))
            for i in unknown:
                numbers[i] = self[keys[i]]
        lens = np.cumsum([0, *(len(a) for _, a, _ in whole)])
        cuts = np.searchsorted(starts, lens)
        number = np.array(numbers)
        n_groups = np.add.reduceat(self.groups.values[number], cuts[:-1])
        n_links = np.add.reduceat(self.links.values[number], cuts[:-1])
        # pairs of each document's distinct windows, then of each document
        m, width = len(self.shown), len(self.a_len) * len(self.b_len)
        own, count = np.unique(np.repeat(np.arange(len(whole)) * m, np.diff(cuts)) + number, return_counts=True)
        window, doc = own % m, own // m
        begin = self.pair_from.values[window]
        size = np.where(window + 1 < m, self.pair_from.values[np.minimum(window + 1, m - 1)], self.codes.n) - begin
        at = np.repeat(begin - (size.cumsum() - size), size) + np.arange(size.sum())
        code = np.repeat(doc * width, size) + self.codes.values[at]
        links = self.times.values[at] * np.repeat(count, size)
        order = code.argsort()
        code = code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        links, code = np.add.reduceat(links[order], first), code[first]
        ends = np.searchsorted(code, np.arange(len(whole) + 1) * width).tolist()
        code %= width
        for k, ((i, a, b), lo, hi) in enumerate(zip(whole, cuts.tolist(), cuts.tolist()[1:])):
            digest = hashlib.sha256(b";".join(map(self.shown.__getitem__, numbers[lo:hi]))).hexdigest()
            out[i] = Alignment(len(a), len(b), int(n_groups[k]), int(n_links[k]), digest, code[ends[k]:ends[k + 1]],
                               links[ends[k]:ends[k + 1]])
        return out


def aligner(a_path: str, b_path: str) -> Aligner:
    cache = worker_cache()
    key = ("aligner", a_path, b_path)
    if key not in cache:
        cache[key] = Aligner(a_path, b_path)
    return cache[key]


_ROW = "_u long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _lists(arrays, kind):
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *arrays]), kind))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, a_path: str | None = None,
                    b_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked pairs:
    ``codes`` (a * |B| + b) and ``links`` (how often)."""
    a_path, b_path = a_path or vocabulary_path(A_FILE), b_path or vocabulary_path(B_FILE)

    def run(batches):
        worker = aligner(a_path, b_path)
        for batch in batches:
            row, doc, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars < CHUNK_CHARS):
                    chars += len(texts[hi])
                    hi += 1
                found = worker.align_all(texts[lo:hi])
                n = [pa.array([getattr(f, c) for f in found], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays(
                    [row.slice(lo, hi - lo), doc.slice(lo, hi - lo), *n, pa.array([f.digest for f in found], pa.string()),
                     _lists([f.codes for f in found], pa.int64()), _lists([f.links for f in found], pa.int64())],
                    names=["_u", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "links"])
                lo = hi

    d = docs.select(F.monotonically_increasing_id().alias("_u"), F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # the row numbers are written with the rows: later reads see the same ones
    return materialize(d.mapInArrow(run, _ROW + ", codes array<bigint>, links array<bigint>"), "aligned")


def pair_counts(aligned: DataFrame, b_vocabulary: int) -> DataFrame:
    """code, a, b, docs (documents that link the pair), best (no B id is linked to ``a`` in more documents)."""
    n = aligned.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("docs"))
    n = n.select("code", F.expr(f"code div {b_vocabulary}").alias("a"), (F.col("code") % b_vocabulary).alias("b"), "docs")
    best = F.max("docs").over(Window.partitionBy("a"))  # at most |B| rows
    return materialize(n.withColumn("best", F.col("docs") == best), "aligned-pairs")


def _held_pairs(pairs: DataFrame, limit: int):
    """At most ``limit`` pairs, those of the highest counts: sorted codes, their counts and marks."""
    step = F.floor(F.log2("docs") * 16).cast("int")
    sizes = sorted(pairs.groupBy(step.alias("s")).count().collect(), reverse=True)  # under 16 * 64 rows
    least, held = None, 0
    for r in sizes:
        held += r["count"]
        if held > limit:
            break
        least = r["s"]
    if least is None:
        rows = pairs.limit(0)
    else:
        rows = pairs.filter(step >= least)
    t = rows.select("code", "docs", "best").toPandas().sort_values("code")
    return t["code"].to_numpy(np.int64), t["docs"].to_numpy(np.int64), t["best"].to_numpy(bool)


def link_sums(aligned: DataFrame, pairs: DataFrame, held: int | None = None) -> DataFrame:
    """``aligned`` without its pairs, but with n_best (links whose pair is a best one) and count_sum (pair counts over
    links)."""
    table = aligned.sparkSession.sparkContext.broadcast(_held_pairs(pairs, HELD if held is None else held))

    def run(batches):
        known, docs, best = table.value
        for batch in batches:
            lists, links = batch.column(7), batch.column(8)
            codes, times = lists.flatten().to_numpy(), links.flatten().to_numpy()
            at = np.searchsorted(known, codes)
            hit = at < len(known)
            hit[hit] = known[at[hit]] == codes[hit]
            at = np.where(hit, at, 0)
            lens = lists.value_lengths().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lens)), lens)
            sums = np.zeros((2, len(lens)), np.int64)
            if len(known):
                np.add.at(sums[0], owner, np.where(hit & best[at], times, 0))
                np.add.at(sums[1], owner, np.where(hit, times * docs[at], 0))
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=len(lens)))])
            rest = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[~hit], pa.int64())) for x in (codes, times)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(sums[0]), pa.array(sums[1]), *rest],
                                             names=[*batch.schema.names[:7], "n_best", "count_sum", "codes", "links"])

    part = materialize(aligned.mapInArrow(
        run, _ROW + ", n_best long, count_sum long, codes array<bigint>, links array<bigint>"), "aligned-sums")
    rest = (part.select("_u", F.explode(F.arrays_zip("codes", "links")).alias("_e"))
            .select("_u", F.col("_e.codes").alias("code"), F.col("_e.links").alias("links"))
            .join(pairs.select("code", "docs", "best"), "code").groupBy("_u")
            .agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("_best"),
                 F.sum(F.col("links") * F.col("docs")).alias("_sum")))
    more = {c: (F.col(c) + F.coalesce(F.col(x), F.lit(0))).alias(c) for c, x in (("n_best", "_best"), ("count_sum", "_sum"))}
    return part.join(rest, "_u", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *more.values(),
                                                "groups_sha256")


def align_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, a_path: str | None = None,
                 b_path: str | None = None, held: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(per-document digest, pair table)."""
    a_path, b_path = a_path or vocabulary_path(A_FILE), b_path or vocabulary_path(B_FILE)
    from sentencepiece import SentencePieceProcessor
    aligned = align_documents(docs, id_col, text_col, a_path=a_path, b_path=b_path)
    pairs = pair_counts(aligned, SentencePieceProcessor(model_file=b_path).vocab_size())
    return link_sums(aligned, pairs, held), pairs.select("a", "b", "docs", "best")
