"""Operator 7: n-gram Jaccard join by chosen paths.

A document is the set of its 5-word shingles (fewer than five words: one shingle of all).  Documents with equal sets
are copies and are joined as one text.  A run splits the texts recursively: at each level a text follows the shared
token that a random order, fixed by the run and the path so far, ranks first among its shingles.  Two sets of
similarity s stay together with probability s per level, so a path of ``depth`` levels keeps a pair at s = 0.8 with
probability 0.8^depth, and ``runs`` independent runs are made until the target recall is reached at the threshold.
Paths are functions of a text alone, so all runs are walked where the text is read.  What shares a path is a bucket;
buckets are brute-forced with exact Jaccard tests.  A pair counts in the first run that brings it together, so links
are neither lost nor counted twice.

Scale: only path keys are shuffled for all texts; texts travel only for buckets of two or more.  Buckets above
``block`` texts are compared block against block in separate tasks, so a large group of near copies is neither
capped nor gathered; pairs are never emitted, only link counts and spanning stars.  Components are found by joins.

Defined cases: texts without words (null, empty, blank) have no shingles, link to nothing and are classes of
their own; repeated rows are copies of each other; class ids are the least document id of the class (null if all are
null); an empty table gives no rows; other columns are not read, and ``drop_near_copies`` returns them untouched.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import WORD_PATTERN, materialize, words, worker_cache
from eventide.llm.components import components

MULTIPLIER, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)


def runs_for(recall: float, similarity: float, depth: int) -> int:
    """Independent runs after which a pair at the threshold has been together at least once with this probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** depth)))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= 300_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> SHIFT)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> SHIFT)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    hashes = worker_cache().setdefault("word_hashes", _WordHashes())
    tokens = words(text)
    if not tokens:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    width = min(width, len(w))
    n = len(w) - width + 1
    key = np.full(n, width, np.uint64)
    for j in range(width):
        key = _mixed(key * MULTIPLIER + w[j:n + j])
    return np.unique(key)


def paths(s: np.ndarray, runs: int, depth: int, seed: int) -> np.ndarray:
    """The bucket of a set in each run: the hash of the tokens its path follows."""
    state = _mixed(np.arange(1, runs + 1, dtype=np.uint64) * MULTIPLIER + np.uint64(seed))
    step = max(1, (1 << 20) // max(1, len(s)))
    for _ in range(depth):
        chosen = np.empty(runs, np.uint64)
        for at in range(0, runs, step):  # a few runs at a time for very long texts
            r = slice(at, at + step)
            order = (s[None, :] ^ state[r, None]) * (state[r, None] | np.uint64(1))
            chosen[r] = s[np.argmin(order ^ (order >> SHIFT), axis=1)]
        state = _mixed(state * MULTIPLIER + chosen)
    return state.view(np.int64)


SIGNED = "doc_id long, th long, sig binary, leaves array<long>"


def _sign(width: int, runs: int, depth: int, seed: int):
    def run(batches):
        for b in batches:
            sigs, leaves = [], []
            for text in b.column(2):
                s = shingles(text.as_py(), width)
                sigs.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                leaves.append(paths(s, runs, depth, seed) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sigs, pa.binary()), pa.array(leaves, pa.list_(pa.int64()))],
                ["doc_id", "th", "sig", "leaves"])
    return run


def linked_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, num: int, den: int):
    """Index pairs (i < j, i in left and j in right or the reverse) with Jaccard >= num / den, exactly."""
    sizes = np.array([len(s) for s in sets])
    token, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, ids, n = np.unique(token, return_inverse=True, return_counts=True)
    shared = n > 1
    if not shared.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    column = np.cumsum(shared) - 1
    use = shared[ids]
    owner, ids = owner[use], column[ids[use]]
    order = np.argsort(ids, kind="stable")
    owner, ids = owner[order], ids[order]
    common = np.zeros((len(sets), len(sets)), np.float32)  # counts below 2^24 are exact
    total, width = int(ids[-1]) + 1, 4096
    for at in range(0, total, width):
        lo, hi = np.searchsorted(ids, (at, at + width))
        dense = np.zeros((len(sets), min(width, total - at)), np.float32)
        dense[owner[lo:hi], ids[lo:hi] - at] = 1
        common += dense @ dense.T
    common = common.astype(np.int64)
    either = sizes[:, None] + sizes[None, :] - common
    ok = (den * common >= num * either) & ((left[:, None] & right[None, :]) | (right[:, None] & left[None, :]))
    return np.nonzero(np.triu(ok, 1))


def _stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least linked index of every index's group (within one bucket)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


FOUND = "sig binary, hub binary, n_links long, n_texts long"


def _compare(width: int, num: int, den: int):
    """Buckets arrive as runs of rows with equal (leaf, i, j)."""
    def run(batches):
        current, group = None, {}
        out, held = [], 0

        def close():
            nonlocal held
            if len(group) < 2:
                return
            sig, rows = list(group), list(group.values())
            _, i, j, run_no = current
            sides = np.array([r[0] for r in rows])
            left, right = sides == i, sides == j
            a, b = linked_pairs([r[1] for r in rows], left, right, num, den)
            if len(a) and run_no:
                leaves = np.array([r[2] for r in rows], np.int64)[:, :run_no]
                fresh = np.concatenate([~(leaves[a[s:s + 65536]] == leaves[b[s:s + 65536]]).any(1)
                                        for s in range(0, len(a), 65536)])
                a, b = a[fresh], b[fresh]
            if not len(a):
                return
            copies = np.array([r[3] for r in rows], np.int64)
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            texts = np.bincount(a, minlength=len(rows)) + np.bincount(b, minlength=len(rows))
            hub = _stars(len(rows), a, b)
            for k in np.flatnonzero(texts):
                out.append((sig[k], sig[hub[k]], int(links[k]), int(texts[k])))

        def flush():
            s, h, n, t = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(s, pa.binary()), pa.array(h, pa.binary()),
                                               pa.array(n, pa.int64()), pa.array(t, pa.int64())],
                                              ["sig", "hub", "n_links", "n_texts"])

        for b in batches:
            for leaf, i, j, run_no, side, sig, copies, leaves, text in zip(*(
                    b.column(c) if c == 8 else b.column(c).to_pylist() for c in range(9))):
                if (leaf, i, j, run_no) != current:
                    if current is not None:
                        close()
                    current, group = (leaf, i, j, run_no), {}
                    if len(out) > 10_000:
                        yield flush()
                if sig not in group:
                    group[sig] = (side, shingles(text.as_py(), width), leaves, copies)
        if current is not None:
            close()
        if out:
            yield flush()
    return run


class Join:
    """documents: doc_id, th, sig per row; texts: sig, class_id, keep (doc_id, th), n_links, n_texts per text."""

    def __init__(self, documents: DataFrame, texts: DataFrame):
        self.documents, self.texts = documents, texts


def _key(doc_id: Column, th: Column) -> Column:
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(th.cast("string"), F.lit("")))


def join_texts(docs: DataFrame, id_col="doc_id", text_col="text", *, width: int = 5, num: int = 4, den: int = 5,
               recall: float = 0.9999, depth: int = 3, block: int = 256, seed: int = 7) -> Join:
    """``num / den`` is the similarity, compared exactly in integers."""
    runs = runs_for(recall, num / den, depth)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"),
                       F.col(text_col).alias("text"))
    signed = materialize(base.mapInArrow(_sign(width, runs, depth, seed), SIGNED), "jaccard-signed")
    texts = materialize(
        signed.filter("sig is not null").groupBy("sig")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("rep"),
             F.count(F.lit(1)).alias("copies"), F.first("leaves").alias("leaves")), "jaccard-texts")
    walked = texts.select("sig", F.posexplode("leaves").alias("run", "leaf"))
    full = walked.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    live = (walked.join(full, "leaf").groupBy("sig")
            .agg(F.collect_list(F.struct("leaf", "run", "n")).alias("buckets")))  # at most one per run
    chosen = materialize(texts.join(live, "sig").select(
        _key(F.col("rep.doc_id"), F.col("rep.th")).alias("k"), "sig", "copies", "leaves", "buckets"), "jaccard-live")
    own = F.pmod(F.xxhash64("sig", "leaf"), F.col("blocks")).cast("int")
    rows = (base.select(_key(F.col("doc_id"), F.col("th")).alias("k"), "text").join(chosen, "k")
            .select("sig", "copies", "leaves", "text", F.explode("buckets").alias("x"))
            .select("sig", "copies", "leaves", "text", "x.leaf", "x.run",
                    F.ceil(F.col("x.n") / block).cast("int").alias("blocks"))
            .withColumn("side", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("leaf", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "run", "side",
                    "sig", "copies", "leaves", "text")
            .repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j", "sig"))
    found = materialize(rows.mapInArrow(_compare(width, num, den), FOUND), "jaccard-found")
    counts = found.groupBy("sig").agg(F.sum("n_links").alias("n_links"), F.sum("n_texts").alias("n_texts"))
    groups = components(found.filter("sig <> hub"), "sig", "hub").withColumnRenamed("node", "sig")
    rep = texts.drop("leaves").join(groups, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    first = rep.groupBy("component").agg(F.min("rep").alias("keep"))
    done = (rep.join(first, "component").join(counts, "sig", "left")
            .select("sig", F.col("keep.doc_id").alias("class_id"), "keep",
                    (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"),
                    F.coalesce("n_texts", F.lit(0)).alias("n_texts")))
    return Join(signed.select("doc_id", "th", "sig"), materialize(done, "jaccard-classes"))


def near_copy_classes(docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """One row per document: doc_id, class_id, n_links (other documents at the similarity or above, copies
    included) and n_texts (different texts among them)."""
    join = join_texts(docs, id_col, text_col, **options)
    out = join.documents.join(join.texts.drop("keep"), "sig", "left")
    return out.select("doc_id", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                      .alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      F.coalesce("n_texts", F.lit(0)).alias("n_texts"))


def drop_near_copies(docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The documents of ``docs`` without all but one (the least id) of each class; all columns untouched."""
    from pyspark.sql import Window
    join = join_texts(docs, id_col, text_col, **options)
    keep = join.texts.select(_key(F.col("keep.doc_id"), F.col("keep.th")).alias("_k")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(text_col).alias("_t"), _key(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("_k"))
    has_words = F.coalesce(F.col("_t").rlike(WORD_PATTERN), F.lit(False))
    one = (rows.filter(has_words).drop("_t").join(keep, "_k", "left_semi")
           .withColumn("_n", F.row_number().over(Window.partitionBy("_k").orderBy("_k"))).filter("_n = 1")
           .select("_row"))
    return one.unionByName(rows.filter(~has_words).select("_row")).select("_row.*")


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 5 * c >= 4 * (x.n + y.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS least FROM r GROUP BY a), k AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(c.least, doc_id)) AS class_id, coalesce(k.k, 0) AS n_links
FROM documents LEFT JOIN c ON c.a = doc_id LEFT JOIN k ON k.a = doc_id
"""
