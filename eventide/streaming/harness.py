"""Replay a table as an ordered file stream (tests and demos).

The rows are cut by ``seq`` into ``n_files`` chunks; each chunk is written as
one parquet file with increasing modification time, so the file source reads
them in event order with ``maxFilesPerTrigger=1`` ([V5]).  A final flush row
far in the future closes every open window and timer ([V4]); its ``seq`` is
above every real row and it passes the usual filters.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.timeutil import epoch_micros, ts_type


def write_ordered_files(df: DataFrame, folder: str, n_files: int = 8, seq: str = "seq",
                        flush_row: dict | None = None) -> str:
    os.makedirs(folder, exist_ok=True)
    dtype = ts_type(df, seq)
    o = epoch_micros(seq, dtype) if dtype.startswith("timestamp") else F.col(seq)
    bounds = df.agg(F.min(o).alias("lo"), F.max(o).alias("hi")).first()
    lo, hi = bounds.lo, bounds.hi
    step = (hi - lo) // n_files + 1
    chunks = [df.filter((o >= lo + i * step) & (o < lo + (i + 1) * step)) for i in range(n_files)]
    if flush_row is not None:
        spark = df.sparkSession
        chunks.append(spark.createDataFrame([tuple(flush_row[c] for c in df.columns)], df.schema))
    for i, c in enumerate(chunks):
        stage = f"{folder}/_stage{i}"
        c.coalesce(1).write.mode("overwrite").parquet(stage)
        part = [f for f in os.listdir(stage) if f.endswith(".parquet")][0]
        dst = f"{folder}/f{i:05d}.parquet"
        os.replace(f"{stage}/{part}", dst)
        os.utime(dst, (1_000_000 + i, 1_000_000 + i))
    return folder


def read_ordered_files(spark: SparkSession, folder: str, schema) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("pathGlobFilter", "f*.parquet").parquet(folder))
