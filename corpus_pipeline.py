"""Corpus pipeline over ``documents``: toxicity, line dedup, n-gram Jaccard join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are written as Parquet to
the shared folder and reread.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import jaccard, linededup, mixing, packing, toxicity
from eventide.llm.common import materialize, read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier scores at 0.3 or more go; it is trained on the labelled rows that are not held out."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    return toxicity.reject_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat or nearly repeat an earlier line are cut out of the texts; every document stays."""
    return linededup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies stays."""
    return jaccard.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix takes them."""
    return mixing.sample_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their ids."""
    pieces = packing.pack_documents(docs)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("toxicity", reject_toxic), ("line dedup", dedup_lines), ("n-gram Jaccard join", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack)]

#: A trained classifier, a tokenizer and differencing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
