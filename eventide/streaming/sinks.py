"""Stream sinks and named side outputs.

A stateful processor emits one row type with a ``channel`` column; the named
outputs are filters of it.  ``write_channels`` writes all channels of a
micro-batch in one partitioned write (the stateful plan runs once), to
``channel=<name>/batch=<id>``; a retried batch rewrites its own folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.session import checkpoint_dir


def checkpoint_of(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def write_stream(df: DataFrame, name: str, sink: str = "memory", mode: str = "append",
                 path: str | None = None, checkpoint: str | None = None,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start a stream into ``memory`` (query name = ``name``), ``console`` or a file format."""
    w = (df.writeStream.outputMode(mode).format(sink)
         .option("checkpointLocation", checkpoint or checkpoint_of(df.sparkSession, name)))
    if sink == "memory":
        w = w.queryName(name)
    if path:
        w = w.option("path", path)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


class SideOutputs(dict):
    """Named outputs of one multi-channel result: ``SideOutputs.of(df, ['main', 'late'])['late']``."""

    @classmethod
    def of(cls, df: DataFrame, channels: list[str], column: str = "channel") -> "SideOutputs":
        return cls(split_channels(df, channels, column))


def split_channels(df: DataFrame, channels: list[str], column: str = "channel") -> dict[str, DataFrame]:
    """Named outputs of a multi-channel result (works on batch and streaming DataFrames)."""
    return {c: df.filter(F.col(column) == c).drop(column) for c in channels}


def write_channels(df: DataFrame, name: str, base_path: str, channels: list[str], column: str = "channel",
                   checkpoint: str | None = None) -> StreamingQuery:
    def per_batch(batch: DataFrame, batch_id: int):
        (batch.filter(F.col(column).isin(channels)).withColumn("batch", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(column, "batch").parquet(base_path))

    return (df.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint or checkpoint_of(df.sparkSession, name)).start())
