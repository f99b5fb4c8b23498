"""Operator 10 [native]: mixing sources to target weights by capped water-filling.

A source's target share of all words follows its weight, but stops at ``max_epochs`` times its size; what a
clamped source cannot take is reshared by weight until no source is above its cap.  With the sources in order of
cap / weight the clamped ones are a prefix, so prefix sums give the fixed point of that loop at once: the level
is (total - caps of the prefix) / weights of the rest, and the first source whose cap is not below its share at
that level ends the prefix.

Sampling is seeded: documents of a source stand in the order of md5(seed, doc_id).  Each is taken
``quota div source size`` whole times; the first of the order are taken once more, until the source's quota of
words is met exactly, the last one only with its first words (a fractional repetition).  So a source's words are
its rounded target and no document exceeds ``max_epochs`` repetitions.

Scale: sizes are counted once into a narrow table.  Only per-source and per-(source, order bucket) sums are
windowed; rows of one source are never gathered, except those of the one bucket (of 4096) where its cut falls.
The source table has one row per source; its join back is broadcast only if the planner measures it as small,
else it is a shuffle join that AQE may split at a hot source.

Defined cases: null text or no words: size 0 and taken 0; a null source is a source, last in order; null ids order
first; rows equal in id, size and text share a cut evenly (rounded down); an empty table gives no rows; extra
columns are passed through ``sample_mix`` untouched, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import SPACES, WORD_PATTERN, materialize

WEIGHTS = (5, 2, 1)


class Mix(NamedTuple):
    documents: DataFrame  # doc_id, source, size, order key, bucket
    sources: DataFrame    # one row per source: size, target, whole repetitions and the cut


def _order_key(id_col: Column, text: Column, size: Column, seed: str) -> Column:
    return F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))).alias("m"),
                    id_col.cast("long").alias("i"), size.alias("n"), F.xxhash64(text).alias("x"))


def _source_key(source: Column) -> Column:
    """Never null: a null source is a key of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def fill_targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size): capped water-filling."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    upto, rest = ratio.rowsBetween(Window.unboundedPreceding, -1), ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.row_number().over(by_name) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (n % len(weights) + 1).cast("int")).cast("long")
    s = (sources.withColumn("_w", w).withColumn("_cap", F.col("source_size") * max_epochs)
         .withColumn("_level", (F.sum("source_size").over(everything)
                                - F.coalesce(F.sum("_cap").over(upto), F.lit(0))) / F.sum("_w").over(rest))
         # the level of the first source that stays below its cap: levels only fall after it
         .withColumn("_fill", F.max(F.when(F.col("_w") * F.col("_level") <= F.col("_cap"), F.col("_level")))
                     .over(everything)))
    cap = F.col("_cap").cast("double")
    return (s.withColumn("target", F.coalesce(F.least(F.col("_w") * F.col("_fill"), cap), cap))
            .drop("_w", "_cap", "_level", "_fill"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
             weights=WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> Mix:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    d = materialize(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                    size.alias("size"), F.xxhash64(text_col).alias("_x"))
        .select("doc_id", "source", "size", _source_key(F.col("source")).alias("_s"),
                F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
                         .alias("m"), F.col("doc_id").alias("i"), F.col("size").alias("n"), F.col("_x").alias("x"))
                .alias("_k"))
        .withColumn("_b", F.substring(F.col("_k.m"), 1, 3)), "mix")
    sums = materialize(d.groupBy("_s", "source", "_b").agg(F.sum("size").alias("_n")), "mix-buckets")
    src = fill_targets(sums.groupBy("_s", "source").agg(F.sum("_n").alias("source_size")), weights, max_epochs)
    src = (src.withColumn("_quota", F.round("target").cast("long"))
           .withColumn("whole", F.when(F.col("source_size") > 0, F.expr("_quota div source_size")).otherwise(F.lit(0)))
           .withColumn("_left", F.col("_quota") - F.col("whole") * F.col("source_size")))
    # the bucket, then the row, where the last repetition ends
    prefix = F.sum("_n").over(Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    cut_bucket = (sums.withColumn("_before", F.coalesce(prefix, F.lit(0)))
                  .join(src.select("_s", "_left"), "_s")
                  .filter((F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("_n")))
                  .select("_s", "_b", (F.col("_left") - F.col("_before")).alias("_need")))
    inside = (d.join(cut_bucket, ["_s", "_b"]).groupBy("_s", "_b", "_need", "_k")
              .agg(F.count(F.lit(1)).alias("_c")))
    run = F.sum(F.col("_c") * F.col("_k.n")).over(
        Window.partitionBy("_s").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1))
    cut = (inside.withColumn("_before", F.coalesce(run, F.lit(0)))
           .filter((F.col("_before") <= F.col("_need"))
                   & (F.col("_need") < F.col("_before") + F.col("_c") * F.col("_k.n")))
           .select("_s", F.col("_k").alias("_cut"),
                   F.expr("(_need - _before) div _c").alias("cut_words")))
    src = materialize(src.join(cut, "_s", "left").drop("_quota", "_left"), "mix-sources")
    return Mix(d, src)


def _taken(size: Column, key: Column) -> Column:
    more = (F.when(F.col("_cut").isNull(), F.lit(0)).when(key < F.col("_cut"), size)
            .when(key == F.col("_cut"), F.col("cut_words")).otherwise(F.lit(0)))
    return (F.col("whole") * size + more).cast("long")


def mix_plan_rows(mix: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return (mix.documents.join(mix.sources.drop("source"), "_s")
            .select("doc_id", "size", "source_size", "target", _taken(F.col("size"), F.col("_k")).alias("taken")))


def sample_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
               weights=WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: each document's whole repetitions as rows equal to it, then its fractional one, whose text
    ends after the last taken word.  Returns the columns of ``docs``."""
    mix = plan_mix(docs, id_col, text_col, source_col, weights=weights, max_epochs=max_epochs, seed=seed)
    size = F.coalesce(F.regexp_count(F.col(f"_row.{text_col}"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
            .withColumn("_size", size)
            .withColumn("_key", _order_key(F.col(f"_row.{id_col}"), F.col(f"_row.{text_col}"), F.col("_size"), seed))
            .withColumn("_s", _source_key(F.col(f"_row.{source_col}")))
            .join(mix.sources.drop("source"), "_s")
            .withColumn("_taken", _taken(F.col("_size"), F.col("_key")))
            .filter(F.col("_taken") > 0)
            .withColumn("_part", F.col("_taken") % F.col("_size"))
            .withColumn("_n", F.explode(F.sequence(F.lit(1), F.expr("(_taken + _size - 1) div _size")))))
    text = F.col(f"_row.{text_col}")
    lead = F.regexp_extract(text, f"^[{SPACES}]*", 0)
    pieces = F.regexp_extract_all(text, F.lit(WORD_PATTERN + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.concat(lead, F.array_join(F.slice(pieces, 1, F.col("_part").cast("int")), ""))
    out = F.when(F.col("_n") * F.col("_size") <= F.col("_taken"), text).otherwise(cut)
    return rows.select(*[(out if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


ORACLE = """
WITH d AS (SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 3 * source_size AS cap FROM s),
l AS (SELECT *, CAST((sum(source_size) OVER () - coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS DOUBLE)
    / CAST(sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM w WINDOW r AS (ORDER BY cap / w, source NULLS LAST)),
a AS (SELECT max(level) AS lv FROM l WHERE w * level <= cap),
t AS (SELECT source, source_size, coalesce(least(w * lv, cap), CAST(cap AS DOUBLE)) AS target FROM l, a),
q AS (SELECT d.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size = 0 THEN 0 ELSE (quota // source_size) * size
    + greatest(0, least(size, quota % source_size - before)) END AS BIGINT) AS taken FROM q
"""
