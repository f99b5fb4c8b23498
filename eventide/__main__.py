"""Command line: run any registered batch query or streaming job.

  python -m eventide list
  python -m eventide batch hot_items --sf-dir /data/sf1 --out /data/out/hot_items
  python -m eventide stream login_fail_pairs --source login=/data/login_lines --format text \\
      --sink parquet --out /data/out/pairs [--checkpoint /shared/ckpt/pairs] [--once]
  python -m eventide stream page_windows --source access_log=pages --format kafka --brokers host:9092 --out /data/out
  python -m eventide publish --lines /data/pages.log --topic pages --brokers host:9092

Jobs with several named outputs write each to ``<out>/channel=<name>``, all from one query and one checkpoint.
Batch results are written as parquet (distributed write, nothing collected).
Stream sources are folders of parquet files with the fixture columns, or of
text lines parsed with the positional parsers (``--format text``); text rows
get a deterministic ``seq`` tie-breaker (a hash of the line), since lines
carry no arrival number.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.plans import QUERIES
from eventide.sources import parsers as P
from eventide.sources.connectors import kafka_lines, publish_lines
from eventide.streaming.jobs import OUTPUT_JOBS, SINK_JOBS, STREAM_JOBS
from eventide.streaming.sinks import write_channels, write_stream

TEXT_PARSERS = {"user_behavior": P.parse_user_behavior, "access_log": P.parse_access_log,
                "ad_click": P.parse_ad_click, "login": P.parse_login, "order_events": P.parse_order,
                "receipts": P.parse_receipt}


def stream_source(spark: SparkSession, name: str, path: str, fmt: str, schema=None,
                  max_files: int | None = None, brokers: str | None = None) -> DataFrame:
    if fmt == "kafka":
        lines = kafka_lines(spark, brokers, path, group_id=f"eventide-{name}", starting_offsets="earliest")
        return TEXT_PARSERS[name](lines.withColumn("seq", F.xxhash64("value"))).rows
    r = spark.readStream.format(fmt)
    if schema is not None and fmt != "text":
        r = r.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    src = r.load(path)
    if fmt != "text":
        return src
    # lines carry no arrival number: a hash of the line is a deterministic tie-breaker
    return TEXT_PARSERS[name](src.withColumn("seq", F.xxhash64("value"))).rows


def main(argv=None):
    ap = argparse.ArgumentParser(prog="eventide")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    b = sub.add_parser("batch")
    b.add_argument("query")
    b.add_argument("--sf-dir", required=True)
    b.add_argument("--out", required=True)
    s = sub.add_parser("stream")
    s.add_argument("job")
    s.add_argument("--source", action="append", default=[], help="name=path, or name=topic with --format kafka")
    s.add_argument("--format", default="parquet", choices=["parquet", "text", "json", "orc", "kafka"])
    s.add_argument("--brokers", default="localhost:9092", help="Kafka bootstrap servers")
    s.add_argument("--schema-from", help="batch folder whose <name>.parquet files give the source schemas")
    s.add_argument("--sink", default="console", choices=["console", "parquet", "memory"])
    s.add_argument("--out")
    s.add_argument("--checkpoint")
    s.add_argument("--max-files", type=int)
    s.add_argument("--once", action="store_true", help="process what is there, then stop")
    k = sub.add_parser("publish")
    k.add_argument("--lines", required=True, help="text file or folder")
    k.add_argument("--topic", required=True)
    k.add_argument("--brokers", default="localhost:9092")
    a = ap.parse_args(argv)
    if a.cmd == "list":
        print("batch:", " ".join(sorted(QUERIES)))
        print("stream:", " ".join(sorted(STREAM_JOBS)))
        print("stream, to a folder:", " ".join(sorted(OUTPUT_JOBS | SINK_JOBS)))
        return 0
    from eventide.session import get_spark
    spark = SparkSession.getActiveSession() or get_spark()
    if a.cmd == "publish":
        publish_lines(spark, a.lines, a.brokers, a.topic)
        return 0
    if a.cmd == "batch":
        QUERIES[a.query](spark, a.sf_dir).write.mode("overwrite").parquet(a.out)
        return 0
    streams = {}
    for spec in a.source:
        name, path = spec.split("=", 1)
        schema = None
        if a.format != "text" and a.schema_from and a.format != "kafka":
            schema = spark.read.parquet(f"{a.schema_from.rstrip('/')}/{name}.parquet").schema
        streams[name] = stream_source(spark, name, path, a.format, schema, a.max_files, a.brokers)
    if a.job in OUTPUT_JOBS | SINK_JOBS and not a.out:
        ap.error(f"{a.job} writes a folder: give --out")
    if a.job in SINK_JOBS:
        q = SINK_JOBS[a.job](streams, a.out, a.checkpoint)
    elif a.job in OUTPUT_JOBS:
        job, channels = OUTPUT_JOBS[a.job]
        q = write_channels(job(streams), a.job, a.out, list(channels), checkpoint=a.checkpoint)
    else:
        q = write_stream(STREAM_JOBS[a.job](streams), a.job, sink=a.sink, path=a.out, checkpoint=a.checkpoint)
    if a.once:
        q.processAllAvailable()
        q.stop()
    else:
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
