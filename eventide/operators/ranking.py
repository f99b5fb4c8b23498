"""Top-N per window.

``row_number() <= n`` over ``partitionBy(window_end)`` makes Catalyst insert a
WindowGroupLimit twice: a *partial* limit before the exchange (each map task
keeps at most n rows per window) and a final one after.  So even a window with
millions of keys ships at most n rows per map task - bounded, skew-safe.
Ties are broken by the key ascending, so the ranking is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_window(counts: DataFrame, n: int, key: str, window_end: str = "window_end",
                     cnt: str = "cnt", rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(window_end).orderBy(F.col(cnt).desc(), F.col(key).asc())
    return (counts.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
            .select(window_end, rank, key, cnt))
