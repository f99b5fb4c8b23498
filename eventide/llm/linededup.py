"""Operator 9 [native]: exact set-similarity join of lines; later matches are removed.

A line (split at newlines) with at least ``min_words`` words is the set of its 5-word shingles.  It is removed when
it repeats an earlier line exactly, or when some earlier line (kept or not) has Jaccard similarity of num / den or
more with it.  Earlier means smaller (document id, text hash, position); shorter lines stay.

1. Exact repeats: the first place of every line by a partial aggregate over line hashes; no text is shuffled.
2. Screen: tokens are ordered by their first word, so that a line hashes few of them whole.  Similar lines
   share l tokens among the first n - ceil(s n) + l of each (prefix filter, l about a twentieth of n; repeats of a line
   are pre-aggregated away first).  Only lines with that many tokens that other lines are entered under too go on.
3. Their shingles are counted exactly.  A line goes on if ceil(s n) of its shingles or more occur in other lines too;
   rarest first is the order of a second prefix filter, whose positions count only such shingles.
4. Each line meets the earliest line (pivot) of every token it is entered under.  Most near copies are settled there.
5. A line x unlike its pivot P and a line y that are similar differ from P in the same way: with Dx the tokens in just
   one of x and P, |Dx| + |Dy| - 2 |Dx & Dy| = |x ^ y|, at most f (nx + ny) with f = (1 - s) / (1 + s), while
   |Dx| > f (nx + nP) and |Dy| >= |ny - nP|.  So those lines meet by a prefix filter over the differences, rarest of
   the pivot's group first: near copies that share their base but not their edits do not meet at all.
6. Candidates are verified by exact Jaccard on whole token sets; removed places are grouped per document and cut out.

Before a large side is shuffled to meet a list of keys, a semi join with at most 2^20 key buckets (a proven size,
broadcast) drops rows that cannot meet it.  All steps are DataFrame functions.

Defined cases: null text stays null, an empty one empty; a document may lose all lines and stays as an empty text;
rows equal in id and text are one document (both keep a line); null ids come first; an empty table gives no rows;
all other columns pass untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize, release_shuffles

FILTER_BITS = 20


def _enough(line: Column, n: int) -> Column:
    return line.rlike(r"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){%d}[^\x20\x09-\x0D]" % (n - 1))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row (plans would otherwise repeat it at every use)."""
    return F.get(F.transform(F.array(value), body), 0)


def _words(line: Column) -> Column:
    """Rare spaces become the plain one first: a split at one plain character needs no regular expression."""
    plain = F.when(line.rlike(r"[\x09-\x0D]"), F.regexp_replace(line, r"[\x09-\x0D]", " ")).otherwise(line)
    return F.array_remove(F.split(plain, " "), "")


def _shingles(line: Column, width: int) -> Column:
    """64-bit hashes of the line's shingles (it has at least ``width`` words)."""
    return _let(_words(line), lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - width),
                                                    lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)])))


def _prefix(lines: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(k1, least, t): tokens a line is entered under in the screen, and how many of them a similar line shares.

    The order of tokens is by their first word.  With N shingles, repeats counted, all up to the q-th different first
    word are taken, which are q different shingles or more; q = N - ceil(s N) + l, l = 1 + N // 20.  A similar line has
    s u shingles or more, u being the number of different first words, so its l is ``least`` or more.  Words
    are compared, not hashed: Spark interprets lambdas, so only the tokens that are taken are hashed.
    """
    w, o, n = F.col("w"), F.col("o"), F.size("w") - (width - 1)
    q = n - _ceil_div(n * num, den) + 1 + F.floor(n / 20).cast("int")
    taken = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, i) <= F.col("last"))
    tokens = F.array_distinct(F.transform(taken, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)])))
    return (lines.select("k1", _words(F.col("line")).alias("w"))
            .select("k1", "w", F.sort_array(F.array_distinct(F.slice(w, F.lit(1), n))).alias("o"))
            .select("k1", "w", F.get(o, F.least(q, F.size(o)) - 1).alias("last"),
                    (F.floor(_ceil_div(F.size(o) * num, den) / 20) + 1).cast("int").alias("least"))
            .select("k1", "least", tokens.alias("x")).select("k1", "least", F.explode_outer("x").alias("t")))


def _bucket(h, bits: int) -> Column:
    return F.col(h).bitwiseAND(F.lit((1 << bits) - 1)) if isinstance(h, str) else h.bitwiseAND(F.lit((1 << bits) - 1))


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """doc, th, pos, line and its two 64-bit hashes, for lines long enough."""
    return (docs.select("doc", "th", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .filter(_enough(F.col("line"), min_words))
            .withColumn("k1", F.xxhash64("line")).withColumn("k2", F.xxhash64(F.lit(1), "line")))


def _among(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key's bucket holds one of ``keys`` (``left_anti``: none): at most 2^20 buckets are broadcast."""
    buckets = keys.select(_bucket(key, FILTER_BITS).alias("_f")).distinct()
    return rows.join(F.broadcast(buckets), _bucket(key, FILTER_BITS) == F.col("_f"), how)


def _long_enough(na: Column, nb: Column, num: int, den: int) -> Column:
    return den * F.least(na, nb) >= num * F.greatest(na, nb)


def _most_shared(pa: Column, ka: Column, pb: Column, kb: Column) -> Column:
    """Bound on the shared tokens of two ordered lists of ka and kb that share the ones at pa and pb: those before on
    the shorter side, it, and those after it."""
    return F.least(pa, pb) + F.least(ka - pa, kb - pb)


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("int")


def _rarest_first(tokens: DataFrame, group: list[str], keys: list[str]) -> DataFrame:
    """``keys`` and the list ``x`` of a line's tokens t that others of the ``group`` share, rarest first."""
    counts = materialize(tokens.groupBy(*group, "t").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "line-counts")
    release_shuffles(tokens.sparkSession)
    return (tokens.join(counts, [*group, "t"]).groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("x")))  # at most the tokens of a line


def _entries(lines: DataFrame, least: Column, *more: str) -> DataFrame:
    """A row for every token under which a line that must share ``least`` of its list ``x`` is entered."""
    first = F.slice("x", F.lit(1), F.greatest(F.lit(0), F.size("x") - least + 1))
    return (lines.select(*more, F.size("x").alias("k"), F.posexplode(first).alias("p", "e"))
            .select(*more, "k", "p", F.col("e.t").alias("t")))


def repeated_places(docs: DataFrame, *, width: int = 5, num: int = 4, den: int = 5, min_words: int = 5) -> DataFrame:
    """(doc, th, pos) of every line to remove; ``docs`` has doc, th, text."""
    lines = _lines(docs, max(width, min_words))
    where = materialize(lines.drop("line"), "line-keys")
    # a number per different line, in the order of first places: later steps compare and ship only that number
    first_place = F.col("o")
    places = materialize(
        where.groupBy("k1", "k2").agg(F.min(F.struct("doc", "th", "pos")).alias("o"), F.count(F.lit(1)).alias("c"))
        .repartitionByRange(first_place).sortWithinPartitions(first_place)
        .withColumn("id", F.monotonically_increasing_id()), "line-places")
    shingles = _shingles(F.col("line"), width)

    # every line once: those in no bucket of a repeated line as they are read, the others after a grouping
    repeated = places.filter("c > 1").select("k1")
    text = lines.select("k1", "k2", "line")
    once = _among(text, repeated, "k1", "left_anti").select("k1", "line")
    many = _among(text, repeated, "k1").groupBy("k1", "k2").agg(F.first("line").alias("line")).select("k1", "line")
    token = Window.partitionBy("t")
    index = _prefix(once.unionByName(many), width, num, den)
    met = (index.withColumn("_a", F.min("k1").over(token)).withColumn("_b", F.max("k1").over(token))
           .filter("_a <> _b").groupBy("k1", "least").agg(F.count(F.lit(1)).alias("c")).filter("c >= least")
           .select("k1").distinct())
    met = materialize(met, "line-met")
    release_shuffles(docs.sparkSession)

    # the token sets of these lines, at their first places
    at = F.xxhash64("o.doc", "o.th", "o.pos")
    ends = materialize(_among(places, met, "k1").join(met, "k1").select("id", "k1", "k2", at.alias("at")), "line-ends")
    found = (_among(lines.select("k1", "k2", "line", F.xxhash64("doc", "th", "pos").alias("at")), ends, "at")
             .join(ends, ["at", "k1", "k2"]))
    sets = materialize(found.select("id", F.array_distinct(shingles).alias("s")), "line-sets")
    release_shuffles(docs.sparkSession)
    tokens = sets.select("id", F.size("s").alias("n"), F.explode_outer("s").alias("t"))
    n, need = F.col("n"), _ceil_div(F.col("n") * num, den)
    shared = materialize(_rarest_first(tokens, [], ["id", "n"]).filter(F.size("x") >= need), "line-shared")
    release_shuffles(docs.sparkSession)
    sets = sets.join(shared.select("id"), "id", "left_semi")

    # each line and the earliest of every token: what only one of the two has
    entries = _entries(shared, need, "id", "n")
    earliest = entries.groupBy("t").agg(F.min("id").alias("pivot"), F.max("id").alias("_z")).filter("pivot < _z")
    pivots = materialize(entries.join(earliest, "t").filter("id > pivot").select("id", "pivot").distinct(), "line-pivots")
    a, b = sets.withColumnRenamed("s", "sa"), sets.select(F.col("id").alias("pivot"), F.col("s").alias("sb"))
    differ = F.concat(F.array_except("sa", "sb"), F.array_except("sb", "sa"))
    deltas = (pivots.join(a, "id").join(b, "pivot")
              .select("id", "pivot", F.size("sa").alias("n"), F.size("sb").alias("m"), differ.alias("d"))
              .withColumn("near", (den + num) * F.size("d") <= (den - num) * (n + F.col("m"))))
    deltas = materialize(deltas, "line-deltas")
    release_shuffles(docs.sparkSession)
    settled = deltas.filter("near").select("id").distinct()

    # lines unlike all their pivots meet the others of a pivot by what they differ in
    alone = deltas.select("id").distinct().join(settled, "id", "left_anti").withColumn("open", F.lit(True))
    group = deltas.select("id", "pivot").join(alone, "id", "left")
    group = group.groupBy("pivot").agg(F.count(F.lit(1)).alias("c"), F.max("open").alias("o")).filter("c > 1 and o")
    some = deltas.join(group.select("pivot"), "pivot", "left_semi").join(alone, "id", "left")
    some = materialize(some.withColumn("w", F.size("d")).drop("near"), "line-open")
    by = ["id", "pivot", "n", "m", "w", "open"]
    ranked = _rarest_first(some.select(*by, F.explode("d").alias("t")), ["pivot"], by)
    w = F.col("w")
    least = F.greatest(F.lit(1), w - F.floor((den - num) * n / num).cast("int"),
                       _ceil_div((den + num) * w - (den - num) * (n + F.col("m")), 2 * (den + num)))
    x = materialize(_entries(ranked, least, "id", "pivot", "n", "w", "open"), "line-differences")
    y = x.select("pivot", "t", F.col("id").alias("other"), F.col("n").alias("n2"), F.col("w").alias("w2"),
                 F.col("k").alias("k2"), F.col("p").alias("p2"))
    most = _most_shared(F.col("p"), F.col("k"), F.col("p2"), F.col("k2"))
    pairs = x.filter("open").join(y, ["pivot", "t"]).filter(
        (F.col("id") > F.col("other")) & _long_enough(n, F.col("n2"), num, den)
        & ((den + num) * (w + F.col("w2") - 2 * most) <= (den - num) * (n + F.col("n2"))))
    pairs = materialize(pairs.select("id", "other").distinct(), "line-pairs")
    common = F.size(F.array_intersect("sa", "sb"))
    late = (pairs.join(a, "id").join(b.withColumnRenamed("pivot", "other"), "other")
            .filter(den * common >= num * (F.size("sa") + F.size("sb") - common)).select("id").distinct())
    near = settled.unionByName(late)
    gone = (places.join(near.withColumn("near", F.lit(True)), "id", "left")
            .filter("c > 1 or near").select("k1", "k2", "o", "near"))
    gone = materialize(gone, "line-gone")
    release_shuffles(docs.sparkSession)
    return (_among(where, gone, "k1").join(gone, ["k1", "k2"])
            .filter(F.col("near") | (F.struct("doc", "th", "pos") != F.col("o"))).select("doc", "th", "pos"))


def _key(doc: Column, th: Column) -> Column:
    return F.concat_ws("|", F.coalesce(doc.cast("string"), F.lit("")), F.coalesce(th.cast("string"), F.lit("")))


def dedup_lines(docs: DataFrame, id_col="doc_id", text_col="text", counts: bool = False, **options) -> DataFrame:
    """The rows of ``docs`` with repeated lines removed from the text.  ``counts`` adds n_lines and n_removed."""
    keyed = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"),
                        F.col(text_col).alias("text"))
    removed = (repeated_places(keyed, **options).groupBy(_key(F.col("doc"), F.col("th")).alias("_k"))
               .agg(F.collect_set("pos").alias("_gone")))  # at most the lines of one document
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("_t"),
                       _key(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("_k"))
    rows = rows.join(removed, "_k", "left").withColumn("_lines", F.split("_t", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col("_t")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n"))
    out = [(text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]
    if counts:
        out += [F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
                F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed")]
    return rows.select(*out)


ORACLE = """
WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM l),
f AS (SELECT line, any_value(w) AS w, min((doc_id, pos)) AS o, row_number() OVER (ORDER BY min((doc_id, pos))) AS i FROM w WHERE len(w) >= 5 GROUP BY line),
s AS (SELECT DISTINCT i, unnest([array_to_string(w[j:j + 4], ' ') FOR j IN range(1, len(w) - 3)]) AS s FROM f),
n AS (SELECT i, count(*) AS n FROM s GROUP BY i),
p AS (SELECT a.i AS a, b.i AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.i > b.i GROUP BY 1, 2),
g AS (SELECT DISTINCT p.a FROM p JOIN n x ON x.i = p.a JOIN n y ON y.i = p.b WHERE 5 * c >= 4 * (x.n + y.n - c)),
r AS (SELECT w.doc_id, w.pos FROM w JOIN f ON w.line = f.line LEFT JOIN g ON g.a = f.i
    WHERE len(w.w) >= 5 AND (g.a IS NOT NULL OR f.o <> (w.doc_id, w.pos))),
k AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) FILTER (r.pos IS NULL) AS text, count(*) AS n_lines, count(r.pos) AS n_removed
    FROM l LEFT JOIN r ON r.doc_id = l.doc_id AND r.pos = l.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_removed, 0) AS n_removed FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""
