"""Operator 5: exact top-k inner products over norm-sorted, SVD-rotated vectors.

Vectors are scaled to integers floor(scale * x).  The eigenvectors of their Gram matrix (summed by Spark) rotate
them so that the first dimensions carry most of the length.  The index is the rotated vectors in blocks, by
descending length.  A query takes blocks in that order: a block whose longest vector cannot reach the query's
current k-th score (Cauchy-Schwarz: |q| |v|) is skipped; inside a block the product of the first dimensions plus
the product of the residual lengths bounds a score from above, and only vectors whose bound reaches the k-th score
are scored exactly, on the integers.  The head of the index (its longest vectors) is searched first, and its k-th
scores are the thresholds of all other tasks.

Scale: the index is range-partitioned by length; every task holds one block.  Queries go in chunks of
``chunk_mb`` (a fixed bound, broadcast), each against all blocks: a block nested loop, as a query set that is a
share of the table asks.  Each task returns at most k rows per query.

Defined cases: vectors that are null or hold null or non-finite components, and rows with a null id take no part; a
scaled component or one of the k best scores beyond 64 bits is an error, other scores are exact at any size; shorter vectors count as padded with zeros; an empty vector scores 0;
every row with the query's id is left out of its answer; equal query rows are answered once, equal candidate rows
each count; ties go to the smaller id; empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize, shared_dir

VECTOR = "vec_id long, dims int, ints binary, norm double"
BLOCK = "n int, max_norm double, ids binary, ints binary"
HITS = "query_id long, vec_id long, score long"


def _scaler(scale: int):
    def run(batches):
        for b in batches:
            ids, dims, ints, norms = [], [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                if i is None or not v.is_valid or v.values is None or v.values.null_count:
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(v.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if not np.isfinite(v.values.to_numpy(zero_copy_only=False).astype(np.float64)).all():
                    continue
                if (np.abs(x) >= 2.0 ** 63).any():
                    raise OverflowError(f"vector {i}: a scaled component does not fit 64 bits")
                ids.append(i)
                dims.append(len(x))
                ints.append(x.astype("<i8").tobytes())
                norms.append(float(np.sqrt(x @ x)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(ints, pa.binary()), pa.array(norms, pa.float64())],
                                             ["vec_id", "dims", "ints", "norm"])
    return run


def _matrix(column, d: int) -> np.ndarray:
    out = np.zeros((len(column), d), np.int64)
    for r, v in enumerate(column):
        x = np.frombuffer(v.as_py(), "<i8")
        out[r, :len(x)] = x
    return out


def _gram(d: int):
    def run(batches):
        total = np.zeros((d, d))
        for b in batches:
            x = _matrix(b.column(0), d).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["gram"])
    return run


def _add_grams(batches):
    total = None
    for b in batches:
        for g in b.column(0):
            x = np.frombuffer(g.as_py())
            total = x.copy() if total is None else total + x
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["gram"])


def rotation(vectors: DataFrame, d: int, fan_in: int = 16) -> np.ndarray:
    """Eigenvectors of the Gram matrix, largest first; partial sums are added over two levels of tasks."""
    parts = vectors.select("ints").mapInArrow(_gram(d), "gram binary")
    for n in (fan_in, 1):
        parts = parts.repartition(n).mapInArrow(_add_grams, "gram binary")
    row = parts.first()
    values, axes = np.linalg.eigh(np.frombuffer(row["gram"]).reshape(d, d))
    return axes[:, np.argsort(-values)]


def _blocks(size: int):
    def run(batches):
        rows = []

        def block(rows):
            ids, ints, norms = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(ids)], pa.int32()), pa.array([max(norms)]),
                 pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([_pack(ints)], pa.binary())],
                ["n", "max_norm", "ids", "ints"])

        for b in batches:
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                rows.append(row)
                if len(rows) == size:
                    yield block(rows)
                    rows = []
        if rows:
            yield block(rows)
    return run


def _pack(ints) -> bytes:
    width = max(map(len, ints))
    return b"".join(x.ljust(width, b"\0") for x in ints)


def _unpack(raw: bytes, n: int, d: int) -> np.ndarray:
    x = np.frombuffer(raw, "<i8").reshape(n, -1)
    return np.pad(x, ((0, 0), (0, d - x.shape[1])))


class Search:
    """Top-k of a chunk of queries over blocks that arrive by descending length."""

    def __init__(self, ids, ints, axes, k: int, head: int, floor=None):
        self.ids, self.ints, self.axes, self.k, self.head = ids, ints, axes, k, head
        self.floats = ints.astype(np.float64)
        self.norms = np.sqrt((self.floats ** 2).sum(1))
        self.rotated = self.floats @ axes
        self.rest = np.sqrt((self.rotated[:, head:] ** 2).sum(1))
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.astype(np.float64)
        self.best = [np.zeros(0, np.int64)] * 3  # query number, score, vec_id
        self.scored = 0

    def block(self, ids, ints, max_norm: float) -> None:
        live = np.flatnonzero(self.norms * max_norm * (1 + 1e-9) + 1e-6 >= self.floor)
        if not len(live):
            return
        floats = ints.astype(np.float64)
        rotated = floats @ self.axes
        rest = np.sqrt((rotated[:, self.head:] ** 2).sum(1))
        length = np.sqrt((floats ** 2).sum(1))
        bound = self.rotated[live, :self.head] @ rotated[:, :self.head].T + np.outer(self.rest[live], rest)
        bound += 1e-9 * np.outer(self.norms[live], length) + 1e-6
        may = bound >= self.floor[live, None]
        may &= ids[None, :] != self.ids[live, None]
        q, v = np.nonzero(may)
        if not len(q):
            return
        largest = max(np.abs(floats).max(initial=0), 1) * max(np.abs(self.floats).max(initial=0), 1) * floats.shape[1]
        if largest < 2 ** 53 and len(q) * 8 > may.size:
            score = (self.floats[live] @ floats.T)[q, v].astype(np.int64)
        else:
            # beyond 64 bits the sums are taken on Python's integers
            kind = np.int64 if largest < 2 ** 62 else object
            score = np.empty(len(q), kind)
            for at in range(0, len(q), 1 << 16):
                s = slice(at, at + (1 << 16))
                score[s] = (self.ints[live[q[s]]].astype(kind) * ints[v[s]].astype(kind)).sum(1)
        self.scored += len(q)
        hit = score >= self.floor[live[q]]
        q, v, score = live[q[hit]], v[hit], score[hit]
        self._merge(q, score, ids[v])

    def _merge(self, q, score, ids) -> None:
        q, score, ids = (np.concatenate([a, b]) for a, b in zip(self.best, (q, score, ids)))
        if score.dtype == object:
            order = np.array(sorted(range(len(q)), key=lambda i: (q[i], -score[i], ids[i])), np.int64)
        else:
            order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, "left")
        keep = place < self.k
        self.best = [q[keep], score[keep], ids[keep]]
        last = place == self.k - 1
        least = score[last].astype(np.float64)
        # a float may lie above the score it stands for
        least = np.where(np.abs(least) < 2 ** 53, least, np.nextafter(least, -np.inf))
        self.floor[q[last]] = np.maximum(self.floor[q[last]], least)

    def rows(self):
        q, score, ids = self.best
        if score.dtype == object:
            if any(x >= 1 << 63 for x in score):
                raise OverflowError("a score does not fit 64 bits")
            # null: below 64 bits, an error only if it is among the best of all tasks
            score = [x if x >= -1 << 63 else None for x in score]
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(ids), pa.array(score, pa.int64())],
                                          ["query_id", "vec_id", "score"])


def _search(shared, d: int, k: int, head: int):
    def run(batches):
        ids, ints, axes, floor = shared.value
        search = Search(ids, ints, axes, k, head, floor)
        for b in batches:
            for n, top, vec, raw in zip(*(b.column(i).to_pylist() for i in range(4))):
                search.block(np.frombuffer(vec, "<i8"), _unpack(raw, n, d), top)
        yield search.rows()
    return run


def top_k(vectors: DataFrame, queries: Column, id_col="vec_id", vector_col="embedding", *, k: int = 10,
          scale: int = 1024, block: int = 1024, head_share: float = 0.25, chunk_mb: int = 4) -> DataFrame:
    """query_id, rank (from 1), vec_id, score.  ``queries``: which rows are queries (a condition on ``vec_id``)."""
    spark = vectors.sparkSession
    v = materialize(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
                    .mapInArrow(_scaler(scale), VECTOR), "topk-vectors")
    out = shared_dir(spark, "topk-hits")
    spark.createDataFrame([], HITS).write.parquet(out)
    dims = v.agg(F.max("dims")).first()[0]
    if dims:
        axes = rotation(v, dims)
        head = max(1, int(dims * head_share))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = [F.col("norm").desc(), F.col("vec_id")]
        index = materialize(v.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered)
                            .select("vec_id", "ints", "norm").mapInArrow(_blocks(block), BLOCK), "topk-index")
        top = index.agg(F.max("max_norm")).first()[0]
        longest = index.filter(F.col("max_norm") >= top).limit(1)  # one block: enough for first thresholds
        chosen = v.filter(queries).dropDuplicates(["vec_id", "ints"])
        count = chosen.count()
        per_chunk = max(1, (chunk_mb << 20) // (8 * dims))
        n_chunks = -(-count // per_chunk)
        # about per_chunk rows each, by hash
        chosen = materialize(chosen.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "ints"), F.lit(max(1, n_chunks)))),
                             "topk-queries")
        for c in range(n_chunks):
            part = chosen.filter(F.col("chunk") == c).select("vec_id", "ints").toPandas()
            ids = part.vec_id.to_numpy(np.int64)
            ints = _matrix(pa.array(part.ints, pa.binary()), dims)
            seed = Search(ids, ints, axes, k, head)
            for row in longest.collect():
                seed.block(np.frombuffer(row["ids"], "<i8"), _unpack(row["ints"], row["n"], dims), row["max_norm"])
            shared = spark.sparkContext.broadcast((ids, ints, axes, seed.floor))
            hits = index.mapInArrow(_search(shared, dims, k, head), HITS)
            hits.write.mode("append").parquet(out)
            shared.destroy()
    hits = spark.read.schema(HITS).parquet(out)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), "vec_id"))
    wide = F.raise_error(F.lit("a score does not fit 64 bits")).cast("long")
    score = F.when(F.col("score").isNull(), wide).otherwise(F.col("score")).alias("score")
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score)


ORACLE = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
