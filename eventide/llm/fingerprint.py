"""Operator 11 [native]: document fingerprints as bottom-k sketches of shingle hashes.

A text's shingles are its runs of five words (the whole of it if it has fewer), joined by one space.  Each distinct
shingle hashes to the first 64 bits of its md5, as 16 hex digits, whose string order is their number order.  The
sketch is the ascending array of the ``k`` smallest hashes; with fewer than ``k`` it is the whole set and every
estimate from it is exact.

* ``merge`` / ``merge_sketches``: the k smallest of a union are the sketch of the union, so sketches of parts merge.
* ``resemblance`` (Jaccard), ``containment``: among the k smallest hashes of the union, how many lie in both.
* ``distinct_shingles``: (k - 1) / (k-th smallest hash as a share of the hash range).

Scale: a sketch is made where its text is read, by SQL functions alone.  ``edited_texts`` needs each document's
successor by id: ids are cut into ranges at approximate quantiles (at most ``MAX_RANGES`` numbers reach the driver),
each text is shuffled once to its range, and the first row of a range is also sent to the range before it, so
no window spans the table.  ``merge_sketches`` removes repeats by (group, hash) first and then keeps k per group,
which Spark limits on the map side as well, so a hot group is never gathered.

Defined cases: a null text is an empty one; texts without words have the empty sketch, which resembles another
empty one by 1 and any other by 0; rows of one id are ordered by text, null ids come last; an empty table gives no
rows; one row is its own successor; extra columns are not looked at.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
#: Standard error of a resemblance estimate: at most 0.5 / sqrt(K), 0.044.
K = 128
HASH_DIGITS = 16
#: Documents meant for one id range, and how many ranges there may be.
RANGE_ROWS, MAX_RANGES = 2048, 1 << 16


def shingles(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """Runs of ``width`` words, repeats included; all words as one run if there are fewer; none without words."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    run = f"[^ ]++(?: [^ ]++){{{width - 1}}}"
    if width > 1:
        run += rf"|\A[^ ]++(?: [^ ]++){{0,{width - 2}}}\z"
    return F.regexp_extract_all(plain, F.lit(rf"(?:\A|(?<= ))(?=({run}))"), F.lit(1))


def sketch(text: Column, k: int = K, width: int = SHINGLE_WORDS) -> Column:
    """Ascending array of the k smallest distinct shingle hashes."""
    hashes = F.transform(shingles(text, width), lambda s: F.substring(F.md5(s), 1, HASH_DIGITS))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def fingerprint(hashes: Column) -> Column:
    """A sketch as one string; ``parse`` reverses it."""
    return F.array_join(hashes, "")


def parse(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[0-9a-f]{{{HASH_DIGITS}}}"), F.lit(0))


def _union(a: Column, b: Column) -> Column:
    return F.sort_array(F.array_union(a, b))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two texts' shingles."""
    return F.slice(_union(a, b), 1, k)


def _known(a: Column, b: Column, k: int) -> Column:
    """The hashes of the union that both sketches can answer for: all if both are whole sets, else the k smallest."""
    whole = (F.size(a) < k) & (F.size(b) < k)
    return F.slice(_union(a, b), F.lit(1), F.when(whole, F.lit(2 * k)).otherwise(F.lit(k)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A and B| / |A or B|; 1 if both are empty."""
    seen = F.size(_known(a, b, k))
    both = F.size(F.array_intersect(F.array_intersect(a, b), _known(a, b, k)))
    return F.when(seen == 0, F.lit(1.0)).otherwise(both / seen)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A and B| / |A|; 1 if A is empty."""
    of_a = F.size(F.array_intersect(a, _known(a, b, k)))
    both = F.size(F.array_intersect(F.array_intersect(a, b), _known(a, b, k)))
    return F.when(F.size(a) == 0, F.lit(1.0)).when(of_a == 0, F.lit(0.0)).otherwise(both / of_a)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (double); exact below k."""
    digits = 13  # 52 bits: exact in a double
    top = F.conv(F.substring(F.element_at(a, -1), 1, digits), 16, 10).cast("double")
    share = (top + 1.0) / float(16 ** digits)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def merge_sketches(df: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of ``keys``: that of all its rows' shingles together (empty if all are)."""
    hashes = df.select(*keys, F.explode_outer(column).alias("_h")).groupBy(*keys, "_h").agg(F.lit(1).alias("_1"))
    least = Window.partitionBy(*keys).orderBy(F.col("_h").asc_nulls_last())
    return (hashes.withColumn("_r", F.row_number().over(least)).filter(F.col("_r") <= k)
            .groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column)))


def fingerprints(docs: DataFrame, text_col: str = "text", *, k: int = K, width: int = SHINGLE_WORDS,
                 out: str = "sketch") -> DataFrame:
    """``docs`` with the sketch of each text."""
    return docs.withColumn(out, sketch(F.col(text_col), k, width))


def _long_array(values: list[int]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _at_most(bounds: list[int], value: Column) -> Column:
    """How many of the ascending ``bounds`` are <= value: first among every s-th one, then among the s behind it."""
    if not bounds:
        return F.lit(0)
    s = math.isqrt(len(bounds) - 1) + 1
    rows = [bounds[i:i + s] for i in range(0, len(bounds), s)]

    def count(array):
        return F.size(F.filter(array, lambda b: b <= value))

    row = count(_long_array([r[0] for r in rows]))
    inside = count(F.get(F.from_json(F.lit(json.dumps(rows)), "array<array<bigint>>"), row - 1))
    return F.when(row == 0, F.lit(0)).otherwise((row - 1) * s + inside)


def _id_ranges(ids: DataFrame, range_rows: int) -> list[int | None]:
    """First id of every id range, ascending; ``[None]`` if there is no id at all."""
    n = ids.count()
    m = min(MAX_RANGES, math.ceil(n / range_rows))
    cuts = []
    if m > 1:
        grid = F.lit(json.dumps([i / m for i in range(1, m)]))
        q = F.percentile_approx("id", F.from_json(grid, "array<double>"), max(10_000, 8 * m))
        cuts = sorted(set(ids.agg(q.alias("q")).first()["q"] or []))
    # quantiles pass through doubles, so they need not be ids themselves; the least id of each range is
    heads = ids.filter("id IS NOT NULL").groupBy(_at_most(cuts, F.col("id")).alias("b")).agg(F.min("id").alias("id"))
    return sorted(r["id"] for r in heads.collect()) or [None]


def with_next(docs: DataFrame, id_col: str, columns: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each row with ``next_<column>`` of the row after it in ascending id order; the first follows the last."""
    d = docs.withColumn("_id", F.col(id_col).cast("long"))
    heads = _id_ranges(d.select(F.col("_id").alias("id")), range_rows)
    least, bounds = heads[0], heads[1:]
    place = F.when(F.col("_id").isNull(), F.lit(len(bounds))).otherwise(_at_most(bounds, F.col("_id")))
    d = d.withColumn("_b", place.cast("int"))
    # a range's first rows follow the last one of the range before
    here = F.struct(F.col("_b").alias("b"), F.lit(False).alias("guest"))
    before = F.struct((F.col("_b") - 1).alias("b"), F.lit(True).alias("guest"))
    last = F.struct(F.lit(len(bounds)).alias("b"), F.lit(True).alias("guest"))
    is_head = F.size(F.filter(F.slice(_long_array(bounds), F.greatest(F.col("_b"), F.lit(1)), F.lit(1)),
                              lambda b: b == F.col("_id"))) > 0 if bounds else F.lit(False)
    spots = (F.when(F.col("_id").eqNullSafe(F.lit(least).cast("long")), F.array(here, last))
             .when((F.col("_b") > 0) & is_head, F.array(here, before)).otherwise(F.array(here)))
    d = d.withColumn("_s", F.explode(spots)).drop("_b")
    w = Window.partitionBy("_s.b").orderBy("_s.guest", F.col("_id").asc_nulls_last(), *columns)
    return (d.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
            .filter(~F.col("_s.guest")).drop("_s", "_id"))


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = K,
                 width: int = SHINGLE_WORDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, sketch, next_sketch, edited: the text whose last quarter of code points gave way to as many
    first ones of the next document, ascending id."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = with_next(fingerprints(d, k=k, width=width), "doc_id", ["text", "sketch"], range_rows)
    n = F.length("text")
    cut = F.expr("length(text) div 4").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    return d.select("doc_id", "text", "sketch", "next_sketch", edited.alias("edited"))


def fingerprint_digest(edits: DataFrame, *, k: int = K, width: int = SHINGLE_WORDS) -> DataFrame:
    d = edits.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                     F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "sketch", "next_sketch",
                     sketch(F.col("edited"), k, width).alias("_edited"))
    return d.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sketch")).alias("fingerprint"),
                    fingerprint(F.col("_edited")).alias("edited_fingerprint"),
                    resemblance(F.col("sketch"), F.col("_edited"), k).alias("near_edited"),
                    resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
                    distinct_shingles(F.col("sketch"), k).alias("distinct_shingles"),
                    containment(F.col("_edited"), F.col("sketch"), k).alias("edited_within"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id), (SELECT t FROM d ORDER BY doc_id LIMIT 1)) AS nt,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id), (SELECT min(doc_id) FROM d)) AS next_id FROM d),
e AS (SELECT *, substr(t, 1, length(t) - length(t) // 4) || substr(nt, 1, length(t) // 4) AS ed FROM n),
f AS (SELECT doc_id, 0 AS part, t AS x FROM e UNION ALL SELECT doc_id, 1, ed FROM e),
w AS (SELECT doc_id, part, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w FROM f),
g AS (SELECT doc_id, part, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END AS g FROM w),
h AS (SELECT doc_id, part, list_sort(list_distinct(list_transform(g, lambda s: substr(md5(s), 1, 16))))[1:128] AS h
    FROM g),
j AS (SELECT e.doc_id, length(e.t) AS n_chars, sha256(e.ed) AS sha, a.h AS a, b.h AS b, c.h AS c
    FROM e JOIN h a ON a.doc_id = e.doc_id AND a.part = 0 JOIN h b ON b.doc_id = e.doc_id AND b.part = 1
    JOIN h c ON c.doc_id = e.next_id AND c.part = 0),
u AS (SELECT *, list_sort(list_distinct(list_concat(a, b)))[1:CASE WHEN len(a) < 128 AND len(b) < 128 THEN 256 ELSE 128 END] AS ub,
    list_sort(list_distinct(list_concat(a, c)))[1:CASE WHEN len(a) < 128 AND len(c) < 128 THEN 256 ELSE 128 END] AS uc FROM j)
SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, sha AS edited_sha256, array_to_string(a, '') AS fingerprint,
    array_to_string(b, '') AS edited_fingerprint,
    CASE WHEN len(ub) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_intersect(a, b), ub))::DOUBLE / len(ub) END AS near_edited,
    CASE WHEN len(uc) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_intersect(a, c), uc))::DOUBLE / len(uc) END AS near_next,
    CASE WHEN len(a) < 128 THEN len(a)::DOUBLE
        ELSE 127 / ((('0x' || substr(a[128], 1, 13))::BIGINT::DOUBLE + 1.0) / 4503599627370496.0) END AS distinct_shingles,
    CASE WHEN len(b) = 0 THEN 1.0::DOUBLE WHEN len(list_intersect(b, ub)) = 0 THEN 0.0::DOUBLE
        ELSE len(list_intersect(list_intersect(a, b), ub))::DOUBLE / len(list_intersect(b, ub)) END AS edited_within
FROM u
"""
