"""Skew-safe ordered scan: positions and running aggregates inside a key.

Sequential operators (capping, consecutive runs, followed-by, bursts, late
rows) need, for every row, facts about the rows before or after it in
(ts, seq) order inside its key.  A window partitioned by the key alone puts
a hot key (say a third of all rows) into one task.  Instead the key's timeline
is cut into buckets (a column monotone in the order, e.g. the hour of ``ts``):

1. inside each (key, bucket): ``row_number`` and running aggregates (window
   partitioned by key + bucket, so a hot key spreads over many tasks);
2. per (key, bucket): totals - a partial aggregate straight from the input
   (Catalyst pushes it below the window, shuffling one row per bucket);
3. per key: exclusive prefix (or suffix) of the bucket totals - one row per
   non-empty bucket, tiny next to the data;
4. join 3 back on (key, bucket).  The big side is already hash-partitioned
   by (key, bucket) from step 1; only the small side moves (or is broadcast
   when AQE measures it small).

``pos`` = prefix count + in-bucket row number is the exact 1-based position of
the row in its key.  Running sums/mins/maxes (also over structs, e.g. the
latest (ts, seq) of some kind of event) combine the same way, forwards
(``after=False``: rows before) or backwards (``after=True``: rows after).

Hot buckets: with ``fine`` given, per-(key, bucket) row counts are taken
first (a partial aggregate, one row per bucket); buckets holding more than
``hot_rows`` rows are refined to the ``fine`` sub-bucket (e.g. the second of
``ts``).  Sub-buckets lie inside their bucket, so the bucket order stays
monotone and results are unchanged.  The hot list has at most
rows / ``hot_rows`` entries - a proven bound - and is broadcast, so no row
is shuffled by its hot key to find out.

The key columns are packed into one struct column for partitioning and the
join back: a struct is never null and compares null fields as equal, so a
null key (e.g. a missing behaviour) is a key like any other.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventide.timeutil import col, interval_str


class Running(NamedTuple):
    """A running aggregate: ``kind`` in sum/max/min over ``expr``.

    ``inclusive=False`` excludes the current row; ``after=True`` aggregates
    the rows after the current one instead of those before it."""
    name: str
    kind: str
    expr: Column
    inclusive: bool = True
    after: bool = False


_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def time_bucket(ts, width) -> Column:
    """A bucket column for ``ordered_scan``: the start of the tumbling window of ``width``."""
    return F.window(col(ts), interval_str(width)).start


def _combine(kind, other: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(other, F.lit(0)) + F.coalesce(local, F.lit(0))
    if kind == "max":
        return F.greatest(other, local)
    return F.least(other, local)


def ordered_scan(df: DataFrame, keys: list[str], order: list[Column], bucket: Column,
                 running: list[Running] = (), pos: str | None = "pos",
                 window_cols: dict[str, Callable[[WindowSpec], Column]] | None = None,
                 bucket_info: bool = False, fine: Column | None = None,
                 hot_rows: int = 4_000_000) -> DataFrame:
    """Add ``pos`` (1-based position in key) and the ``running`` aggregates to every row.

    ``window_cols`` are extra columns computed over the in-bucket window spec
    (partition (keys, bucket), same order) - exact only where their frame stays
    inside the bucket; ``bucket_info`` adds ``_b_rn`` (row number in bucket) and
    ``_b_n`` (rows in bucket) so callers can fix up the bucket edges.
    """
    window_cols = window_cols or {}
    B, RN = "_scan_b", "_scan_rn"
    first = {B: bucket, **{f"_sv_{r.name}": r.expr for r in running}}
    if keys:
        first["_scan_k"] = F.struct(*[F.col(k) for k in keys])
    d = df.withColumns(first)
    keys = ["_scan_k"] if keys else []
    if fine is not None:
        hot = (d.groupBy(*keys, B).agg(F.count(F.lit(1)).alias("_hn")).filter(F.col("_hn") > hot_rows)
               .select(*keys, B, F.lit(True).alias("_hot")))
        d = (d.join(F.broadcast(hot), on=[*keys, B], how="left")
             .withColumn(B, F.when(F.col("_hot"), fine).otherwise(F.col(B))).drop("_hot"))
    w = Window.partitionBy(*keys, B).orderBy(*order)
    wcols = {RN: F.row_number().over(w)}
    for r in running:
        if r.after:
            frame = w.rowsBetween(Window.currentRow if r.inclusive else 1, Window.unboundedFollowing)
        else:
            frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if r.inclusive else -1)
        wcols[f"_sl_{r.name}"] = _AGG[r.kind](f"_sv_{r.name}").over(frame)
    for name, fn in window_cols.items():
        wcols[name] = fn(w)
    d = d.withColumns(wcols)

    tot = d.groupBy(*keys, B).agg(F.count(F.lit(1)).alias("_st_n"),
                                  *[_AGG[r.kind](f"_sv_{r.name}").alias(f"_st_{r.name}")
                                    for r in running])
    wk = Window.partitionBy(*keys).orderBy(B)
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    after = wk.rowsBetween(1, Window.unboundedFollowing)
    pre = tot.select(*keys, B, F.coalesce(F.sum("_st_n").over(before), F.lit(0)).alias("_sp_n"),
                     F.col("_st_n").alias("_b_n"),
                     *[_AGG[r.kind](f"_st_{r.name}").over(after if r.after else before).alias(f"_sp_{r.name}")
                       for r in running])
    out = d.join(pre, on=[*keys, B], how="inner")
    extra = []
    if pos:
        extra.append((F.col("_sp_n") + F.col(RN)).alias(pos))
    for r in running:
        extra.append(_combine(r.kind, F.col(f"_sp_{r.name}"), F.col(f"_sl_{r.name}")).alias(r.name))
    extra += [F.col(n) for n in window_cols]
    if bucket_info:
        extra += [F.col(RN).alias("_b_rn"), F.col("_b_n")]
    return out.select(*df.columns, *extra)


def fold_groups(df: DataFrame, by: list[str], order: list, fn: Callable, schema: T.StructType) -> DataFrame:
    """Rows of ``fn(key, rows)`` for every group of ``by``; ``rows`` are tuples of ``df`` in ``order``, read once.

    Rows are shuffled by ``by``, sorted, and streamed through the fold: a task holds what ``fn`` holds, not the group."""
    n = [df.columns.index(c) for c in by]
    types = to_arrow_schema(schema)

    def run(batches):
        def rows():
            for b in batches:
                yield from zip(*[c.to_pylist() for c in b.columns])
        def results():
            for key, group in itertools.groupby(rows(), key=lambda r: tuple(r[i] for i in n)):
                yield from fn(key, group)
        found = results()
        while out := list(itertools.islice(found, 4096)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), types)], schema=types)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)
