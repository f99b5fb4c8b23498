"""Operator 4: toxicity by a naive-Bayes-scaled linear classifier over character n-grams.

A text is lower-cased, white space becomes one blank, and its character 3- to 5-grams are hashed to 64 bits; a feature
is the presence of one of the ``n_features`` most telling hashes.  Feature f is scaled by r_f, the log ratio of its smoothed document
frequencies in toxic and clean training texts; a logistic regression with L2 penalty is trained on the scaled
features (NB-SVM).  The score is its probability.

Training reads a bounded sample of labelled rows: at most ``per_class`` toxic and ``2 * per_class`` clean ones
(about, chosen by a hash of the id; the rest of a class is represented by weights).  Their ids are broadcast (the
bound is that parameter) so one scan fetches their texts.  Document frequencies are summed by Spark; the driver
gets the ``n_features`` most telling hashes and, per sample row, which of them it has.

Scoring is one map over the documents: whole texts, in chunks, with a fixed-size work area.

Defined cases: null and empty texts get the score of no features; labels with a null value are ignored, and of
several labels of an id the largest counts; without both classes the score is the share of toxic labels (0 without
labels); null ids are scored and never train; empty tables give no rows; other columns are not read, and
``reject_toxic`` returns them untouched.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import materialize

CHUNK = 1 << 20  # characters hashed at once


class Model(NamedTuple):
    present: np.ndarray  # leading bits of a hash -> whether any feature's hash has them
    keys: np.ndarray     # the features' hashes, sorted
    weights: np.ndarray  # one for each (already scaled by its log-count ratio)
    bias: float
    bits: int            # of ``present``


def hashes(text: str):
    """Arrays of hashed n-grams (n = 3, 4, 5), with repeats, in chunks of the whole text."""
    text = " " + " ".join(text.lower().split()) + " "
    for at in range(0, max(1, len(text) - 2), CHUNK):
        c = np.frombuffer(text[at:at + CHUNK + 4].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = (c[:-1] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ c[1:]
        for n in (3, 4, 5):
            if len(c) < n:
                break
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ c[n - 1:]
            own = h[:CHUNK] ^ (h[:CHUNK] >> np.uint64(29))
            yield own * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF)


def buckets(text: str, bits: int):
    """The leading bits of the hashes."""
    for h in hashes(text):
        yield h >> np.uint64(64 - bits)


def distinct_hashes(text: str | None) -> np.ndarray:
    own = np.zeros(0, np.uint64)
    for h in hashes(text or ""):
        own = np.unique(np.concatenate([own, h]))
    return own


def _frequencies(limit: int = 1 << 22):
    """Of every hash, the toxic texts and all texts that have it (partial sums)."""
    def run(batches):
        parts, held = [[], []], 0

        def flush():
            each, n = np.unique(np.concatenate(parts[0] + parts[1]), return_counts=True)
            toxic = np.zeros(len(each), np.int64)
            if parts[1]:
                own, k = np.unique(np.concatenate(parts[1]), return_counts=True)
                toxic[np.searchsorted(each, own)] = k
            for at in range(0, len(each), 1 << 16):
                s = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(each[s].view(np.int64)), pa.array(toxic[s]), pa.array(n[s])],
                                                 ["gram", "toxic", "n"])
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1)):
                parts[y].append(distinct_hashes(text.as_py()))
                held += len(parts[y][-1])
                if held > limit:
                    yield from flush()
                    parts, held = [[], []], 0
        if held:
            yield from flush()
    return run


def features_of(text: str | None, present: np.ndarray, keys: np.ndarray, bits: int):
    """Arrays of the numbers of the features that the text has, with repeats."""
    for h in hashes(text or "") if len(keys) else ():
        h = h[present[h >> np.uint64(64 - bits)]]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        yield at[keys[at] == h]


def _chosen(present: np.ndarray, keys: np.ndarray, bits: int):
    def run(batches):
        for b in batches:
            out = []
            for text in b.column(1):
                flags = np.zeros(len(keys), bool)
                for at in features_of(text.as_py(), present, keys, bits):
                    flags[at] = True
                out.append(np.flatnonzero(flags).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["label", "features"])
    return run


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, ratio: np.ndarray, l2: float,
                 steps: int = 150, chunk: int = 512) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on presence features scaled by ``ratio``; full-batch Adam steps, a chunk of rows
    at a time (the work area does not grow with the sample)."""
    parts, none = [], np.array([len(ratio)], np.uint16)  # each row also gets a feature of no weight: none is empty
    for at in range(0, len(rows), chunk):
        some = rows[at:at + chunk]
        size = np.array([len(r) + 1 for r in some])
        parts.append((np.concatenate([x for r in some for x in (r, none)]), size, np.cumsum(size) - size,
                      slice(at, at + len(some))))
    w, bias = np.zeros(len(ratio)), 0.0
    m, v, total = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1), weight.sum()
    for t in range(1, steps + 1):
        scaled = np.append(w * ratio, 0.0).astype(np.float32)
        g = np.append(l2 * w, 0.0)
        for idx, size, starts, at in parts:
            z = np.add.reduceat(scaled[idx], starts, dtype=np.float64) + bias
            err = weight[at] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]) / total
            g[:-1] += np.bincount(idx, np.repeat(err, size), len(ratio) + 1)[:-1] * ratio
            g[-1] += err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, bias


def train(docs: DataFrame, labels: DataFrame, trains: Column | None = None, id_col="doc_id", text_col="text",
          label_col="toxic", *, per_class: int = 4000, bits: int = 18, n_features: int = 1 << 15,
          smoothing: float = 1.0, penalty: float = 5.0) -> Model:
    """``trains``: which label rows may be learned from (a condition on ``id_col``)."""
    lab = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if trains is not None:
        lab = lab.filter(trains)
    lab = lab.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    n = {r["_y"]: r["n"] for r in lab.groupBy((F.col("_y") > 0).cast("int").alias("_y"))
         .agg(F.count(F.lit(1)).alias("n")).collect()}
    none = Model(np.zeros(1 << bits, bool), np.zeros(0, np.uint64), np.zeros(0, np.float32), -30.0, bits)
    if not n.get(0) or not n.get(1):
        return none._replace(bias=30.0 if n.get(1) else -30.0)
    share = F.when(F.col("_y") > 0, F.lit(0.97 * per_class / n[1])).otherwise(F.lit(0.97 * 2 * per_class / n[0]))
    ids = lab.filter(F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1 << 30)) < share * (1 << 30)).select(
        "_id", (F.col("_y") > 0).cast("int").alias("label"))
    rows = (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(ids), "_id")  # at most 3 * per_class ids
            .select(F.col("_id").alias("doc_id"), "label", "text", F.xxhash64("text").alias("h")))
    sample = materialize(rows.groupBy("doc_id", "label").agg(F.min_by("text", "h").alias("text"))
                         .select("label", "text"), "toxicity-sample")
    got = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not got.get(0) or not got.get(1):
        return none._replace(bias=float(np.log(n[1] / n[0])))
    p = (F.col("toxic") + smoothing) / (got[1] + 2 * smoothing)
    q = (F.col("n") - F.col("toxic") + smoothing) / (got[0] + 2 * smoothing)
    best = (sample.mapInArrow(_frequencies(), "gram long, toxic long, n long").groupBy("gram")
            .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).filter("n >= 2")
            .select("gram", F.log(p / q).alias("ratio"), "n")
            .orderBy((F.abs("ratio") * F.sqrt("n")).desc(), "gram").limit(n_features).toPandas())
    keys, scale = best.gram.to_numpy(np.int64).view(np.uint64), best.ratio.to_numpy(np.float64)
    order = np.argsort(keys)
    keys, scale = keys[order], scale[order]
    present = np.zeros(1 << bits, bool)
    present[keys >> np.uint64(64 - bits)] = True
    data = sample.mapInArrow(_chosen(present, keys, bits), "label int, features binary").toPandas()
    data = data.sort_values(["label", "features"], ignore_index=True)  # the same sums whatever the arrival order
    y = data.label.to_numpy(np.float64)
    weight = np.where(y > 0, n[1] / got[1], n[0] / got[0])
    w, bias = fit_logistic([np.frombuffer(f, "<u2") for f in data.features], y, weight, scale, penalty / len(y))
    return Model(present, keys, (w * scale).astype(np.float32), float(bias), bits)


def score_text(model: Model, text: str | None, flags: np.ndarray) -> float:
    flags[:] = 0
    for at in features_of(text, model.present, model.keys, model.bits):
        flags[at] = 1
    z = float(flags @ model.weights) + model.bias
    return 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))


def _scores(model, column):
    flags = np.zeros(len(model.weights), np.float32)
    return np.array([score_text(model, t.as_py(), flags) for t in column], np.float64)


def score_documents(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2^bits + 2 n_features entries

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(shared.value, b.column(1)))],
                                             ["doc_id", "score"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, score double")


def reject_toxic(docs: DataFrame, model: Model, text_col="text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns untouched."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_scores(shared.value, b.column(at)) < threshold))
    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: Column) -> Column:
    """Fixed rule of the contract: labels of these rows are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
