"""Running distinct visitors of a stream.

A stateful query finds the first sighting of every visitor per window, salted.  Its micro-batches are numbered in a
sink: sightings come in time order from batch to batch, so a sighting's count is its position among the batch's own
sightings of the window (the bucketed ``ordered_scan``, which splits a hot window) plus the window's total so far.
The totals are one row per open window.  Every write of a batch replaces that batch's own files, so a batch that is
run again after a failure gives the same rows once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators.scan import ordered_scan, time_bucket
from eventide.streaming.processors import stream_first_sightings
from eventide.streaming.sinks import checkpoint_of

#: Totals of this many last batches are kept: a batch reads those of the one before it, which are not overwritten.
SLOTS = 4
_TOTALS = "window_end timestamp, n long, batch long"


def number_batch(sightings: DataFrame, batch: int, totals: str, out: str, bucket="1 minute",
                 hot_rows: int = 4_000_000) -> None:
    """Append one batch of first sightings to ``out`` with their running counts, and write the new totals."""
    spark = sightings.sparkSession
    scratch = f"{totals}/sightings"
    sightings.write.mode("overwrite").parquet(scratch)  # the stateful plan runs once
    s = spark.read.schema(sightings.schema).parquet(scratch)
    known = spark.read.schema(_TOTALS).parquet(*[f"{totals}/slot{k}" for k in range(SLOTS) if k != batch % SLOTS])
    known = known.filter(F.col("batch") < batch)
    last = known.agg(F.max("batch")).first()[0]
    known = known.filter(F.col("batch") == last).select("window_end", F.col("n").alias("_before"))
    pos = ordered_scan(s, ["window_end"], [F.col("ts"), F.col("seq")], time_bucket("ts", bucket), pos="_pos",
                       fine=time_bucket("ts", "1 second"), hot_rows=hot_rows)
    uv = (F.coalesce("_before", F.lit(0)) + F.col("_pos")).alias("uv")
    (pos.join(known, "window_end", "left")
     .select("window_end", "bit_offset", "ts", "seq", "user_id", uv, F.lit(batch).alias("batch"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out))
    # a window that ends before this batch's first sighting gets no more
    n = s.groupBy("window_end").agg(F.count(F.lit(1)).alias("n"))
    start = s.agg(F.min("ts")).first()[0]
    both = n.unionByName(known.select("window_end", F.col("_before").alias("n"))).groupBy("window_end").agg(F.sum("n").alias("n"))
    if start is not None:
        both = both.filter(F.col("window_end") > F.lit(start))
    both.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{totals}/slot{batch % SLOTS}")


def write_running_unique_visitors(pv: DataFrame, name: str, out: str, size="1 hour", cap: int = 1 << 29,
                                  checkpoint: str | None = None, salts: int = 32) -> StreamingQuery:
    """Start the job: window_end, bit_offset, ts, seq, user_id, uv in ``out``, in folders by micro-batch."""
    spark = pv.sparkSession
    checkpoint = checkpoint or checkpoint_of(spark, name)
    totals = f"{checkpoint}/totals"
    first = spark.createDataFrame([], _TOTALS).unionByName(
        spark.range(1).select(F.lit(None).cast("timestamp").alias("window_end"), F.lit(0).cast("long").alias("n"),
                              F.lit(-1).cast("long").alias("batch")))
    for k in range(SLOTS):
        first.coalesce(1).write.mode("ignore").parquet(f"{totals}/slot{k}")
    seen = stream_first_sightings(pv, size, cap, salts=salts)
    return (seen.writeStream.foreachBatch(lambda df, batch: number_batch(df, batch, totals, out))
            .option("checkpointLocation", f"{checkpoint}/query").start())
