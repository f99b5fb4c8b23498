"""Connector option builders.

The Kafka connector jar is not on this image's classpath, so these build the
reader/writer and are tested on their option maps; the parsers accept the
``value`` column they produce.  The socket source is Spark's test-only
source and is never started here (no ports are opened in tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest") -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_lines(spark: SparkSession, servers: str, topic: str, group_id: str | None = None,
                starting_offsets: str = "latest") -> DataFrame:
    """A Kafka topic as a stream of string lines in column ``value``."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_options(servers, topic, group_id, starting_offsets).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def socket_lines(spark: SparkSession, host: str = "localhost", port: int = 7777) -> DataFrame:
    """S3: Spark's socket source (test-only in Spark; not started in this repo's tests)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def publish_lines_writer(lines: DataFrame, servers: str, topic: str):
    """Write text lines as value-only Kafka records (batch writer, distributed)."""
    return (lines.select(F.col("value").cast("string").alias("value")).write.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic))


def publish_lines(spark: SparkSession, path: str, servers: str, topic: str) -> None:
    """Publish a text file's lines to a topic as value-only records (one distributed write)."""
    publish_lines_writer(spark.read.text(path), servers, topic).save()
