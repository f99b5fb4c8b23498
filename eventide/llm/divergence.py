"""Operator 13: source divergence audit with hash-consed segment trees over term ids.

Every (language, source) group is a vector of term counts.  Its segment tree has the counts as leaves and, as inner
nodes, pairs of child nodes; equal subtrees, of any group, are one node (hash-consing, level by level).  Two groups
are compared by walking both trees at once from the roots: a pair of nodes met twice is priced once, so stretches
where both groups repeat a pattern (above all stretches of zeros) cost one visit.

A term's smoothed share in a group is p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two shares differ by
f = floor((p - q)^2 / (p + q)).  ``pairs`` sums f over all kept terms for each two sources of a language; ``terms``
are the group's own: count above 0 and p above the language's share, by f.

Scale: tasks count terms where the texts are read and flush their table at ``FLUSH`` entries, so a hot source or word
is pre-aggregated before the one shuffle by (language, term), where no row stands for more than a task's share.
Term ids of a language are dealt by hash into blocks of about ``BLOCK_ROWS`` counts: one block, and one pair of
chunks of ``CHUNK`` sources, is one task, whose trees hang below the language's root; block sums add up.  The pairs
of sources are the result itself, so their number is not reduced.  Only tables of one row per group are windowed by
language.  All arithmetic is on integers (Python's where 64 bits might not do).

Defined cases: null text, language and source read as ''; a language without kept terms gives value 0 for all its
pairs and no terms; a language with one source gives no pairs; repeated rows count as documents of their own; an
empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import materialize

MIN_DOCS, TOP_TERMS = 10, 10
SHARE = 1_000_000_000
FLUSH = 300_000
BLOCK_ROWS, CHUNK, MAX_PARTITIONS = 1 << 16, 64, 20_000
#: Node pairs priced at once by a task.
FRONTIER = 1 << 18

#: Everything but letters ends a term: ASCII letters are lower-cased, bytes of other characters stay.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Audit(NamedTuple):
    pairs: DataFrame   # lang, source, other, value: both directions
    terms: DataFrame   # lang, source, term, value: at least the first ``top`` of each group
    groups: DataFrame  # lang, source, docs, n (occurrences of kept terms), v (kept terms of the language)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TERMS).split() if text else []


_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()),
                      ("d", pa.int64())])


def _flush(tables: dict, docs: Counter):
    """Counts so far as record batches; a row without a term carries a group's number of documents."""
    for (lang, source), (count, seen) in tables.items():
        for lo in range(0, len(count), 50_000):
            terms = list(count)[lo:lo + 50_000]
            yield pa.record_batch([pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                                   pa.array(terms, pa.binary()).cast(pa.string()),
                                   pa.array([count[t] for t in terms], pa.int64()),
                                   pa.array([seen[t] for t in terms], pa.int64())], schema=_PARTIAL)
    if docs:
        yield pa.record_batch([pa.array([k[0] for k in docs], pa.string()), pa.array([k[1] for k in docs], pa.string()),
                               pa.nulls(len(docs), pa.string()), pa.array([0] * len(docs), pa.int64()),
                               pa.array(list(docs.values()), pa.int64())], schema=_PARTIAL)
    tables.clear()
    docs.clear()


def _count_terms(batches):
    tables, docs, held = {}, Counter(), 0
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            key = (lang, source)
            docs[key] += 1
            count, seen = tables.setdefault(key, (Counter(), Counter()))
            words = terms_of(text.as_py())
            before = len(count)
            count.update(words)
            seen.update(set(words))
            held += len(count) - before
            if held > FLUSH or len(docs) > FLUSH:
                yield from _flush(tables, docs)
                held = 0
    yield from _flush(tables, docs)


def kept_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str, min_docs: int) -> DataFrame:
    """lang, source, term, n, lang_n, first: counts of kept terms, one row of each term marked; and, with a null
    term, one row per group whose n is its number of documents."""
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                      for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    part = d.mapInArrow(_count_terms, "lang string, source string, term string, n long, d long")
    # dealt by (lang, term) at once: the grouping by source and both windows need no further shuffle
    c = (part.repartition("lang", "term").groupBy("lang", "source", "term")
         .agg(F.sum("n").alias("n"), F.sum("d").alias("d")))
    term = Window.partitionBy("lang", "term")
    c = c.select("*", F.sum("n").over(term).alias("lang_n"), F.sum("d").over(term).alias("_docs"),
                 F.row_number().over(term.orderBy("source")).alias("_r"))
    own = F.when(F.col("term").isNull(), F.col("d")).otherwise(F.col("n"))
    return (c.filter(F.col("term").isNull() | (F.col("_docs") >= min_docs))
            .select("lang", "source", "term", own.alias("n"), "lang_n",
                    (F.col("term").isNotNull() & (F.col("_r") == 1)).alias("first")))


def group_table(kept: DataFrame) -> DataFrame:
    """One row per group: docs, n, and of its language v, lang_n, blocks, chunks; ``i`` numbers its sources."""
    is_term = F.col("term").isNotNull()
    g = kept.groupBy("lang", "source").agg(
        F.coalesce(F.sum(F.when(~is_term, F.col("n"))), F.lit(0)).alias("docs"),
        F.coalesce(F.sum(F.when(is_term, F.col("n"))), F.lit(0)).alias("n"),
        F.sum(F.col("first").cast("long")).alias("_v"), F.count("term").alias("_rows"))
    lang = Window.partitionBy("lang")
    g = g.select("lang", "source", "docs", "n", F.sum("_v").over(lang).alias("v"), F.sum("n").over(lang).alias("lang_n"),
                 (F.row_number().over(lang.orderBy("source")) - 1).cast("long").alias("i"),
                 F.sum("_rows").over(lang).alias("_rows"), F.count(F.lit(1)).over(lang).alias("_s"))
    return g.select("lang", "source", "docs", "n", "v", "lang_n", "i",
                    F.greatest(F.lit(1), F.ceil(F.col("_rows") / BLOCK_ROWS)).cast("long").alias("blocks"),
                    F.ceil(F.col("_s") / CHUNK).cast("long").alias("chunks"))


class Forest:
    """Hash-consed segment trees of equal length over the columns of ``counts`` (one tree per row; -1 pads)."""

    def __init__(self, counts: np.ndarray):
        self.values, ids = np.unique(counts, return_inverse=True)
        ids = ids.reshape(counts.shape)
        self.leaves, self.children = ids, []
        while ids.shape[1] > 1:
            left, right = ids[:, ::2].astype(np.int64), ids[:, 1::2].astype(np.int64)
            width = int(ids.max()) + 1
            nodes, ids = np.unique(left * width + right, return_inverse=True)
            ids = ids.reshape(left.shape)
            self.children.append((nodes // width, nodes % width))
        self.roots = ids[:, 0]

    def walk(self, a: np.ndarray, b: np.ndarray):
        """Walk trees a[j] and b[j] at once.  Returns the distinct leaf pairs as (j, leaf of a, leaf of b) and a
        function that adds prices of theirs up to one sum for each j."""
        j, x, y = np.arange(len(a)), self.roots[a], self.roots[b]
        steps = []
        for left, right in reversed(self.children):
            j2 = np.concatenate([j, j])
            x2, y2 = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            width = int(max(x2.max(), y2.max())) + 1
            pairs, back = np.unique((j2 * width + x2) * width + y2, return_inverse=True)
            steps.append((back[:len(j)], back[len(j):]))
            j, x, y = pairs // width // width, pairs // width % width, pairs % width

        def total(prices):
            for first, second in reversed(steps):
                prices = prices[first] + prices[second]
            return prices

        return (j, x, y), total


def shares(values: np.ndarray, n: int, v: int) -> np.ndarray:
    """p of every count, exactly; 0 for the padding."""
    exact = (SHARE * (values.astype(object) + 2)) // (int(n) + 2 * int(v)) + 1
    return np.where(values < 0, 0, exact).astype(np.int64)


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // np.maximum(p + q, 1)


_BLOCK = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("term", pa.string()),
                    ("value", pa.int64())])


def _price_block(table: pa.Table, top: int) -> pa.Table:
    """One block of terms of a language, two chunks of its sources: a partial sum for each pair of groups, and the
    best terms of each group of the first chunk where both chunks are the same one."""
    lang, low, high = (table.column(c)[0].as_py() for c in ("lang", "low", "high"))
    marks, rows = table.filter(pc.is_null(table["term"])), table.filter(pc.is_valid(table["term"]))
    groups = dict(zip(marks["i"].to_pylist(), marks["n"].to_pylist()))
    v, lang_n, n_terms = (marks[c][0].as_py() for c in ("v", "lang_n", "terms"))
    order = sorted(groups)
    place = {i: r for r, i in enumerate(order)}
    first = [r for r, i in enumerate(order) if i // CHUNK == low]
    second = [r for r, i in enumerate(order) if i // CHUNK == high]
    ab = np.array([(r, s) for r in first for s in second if r < s], np.int64).reshape(-1, 2)
    out = {"a": [], "b": [], "term": [], "value": []}

    def emit(a, b, term, value):
        for key, column in zip(out, (a, b, term, value)):
            out[key].extend(column)

    index = np.array(order, np.int64)
    if n_terms == 0:
        emit(index[ab[:, 0]].tolist(), index[ab[:, 1]].tolist(), [None] * len(ab), [0] * len(ab))
    else:
        code = pc.dictionary_encode(rows["term"].combine_chunks())
        names, at = code.dictionary.to_pylist(), code.indices.to_numpy()
        total_n = np.zeros(len(names), np.int64)
        total_n[at] = rows["lang_n"].to_numpy()
        # frequent terms first, so that the zeros of rare ones lie together; last those of other chunks' groups alone
        ids = sorted(range(len(names)), key=lambda t: (-total_n[t], names[t]))
        rank = np.empty(len(names), np.int64)
        rank[ids] = np.arange(len(names))
        names = [names[t] for t in ids]
        width = 1 << (n_terms - 1).bit_length()
        counts = np.full((len(order) + 1, width), -1, np.int64)
        counts[:, :n_terms] = 0
        counts[[place[i] for i in rows["i"].to_pylist()], rank[at]] = rows["n"].to_numpy()
        counts[-1, rank] = total_n
        forest = Forest(counts)
        p = np.array([shares(forest.values, groups[i], v) for i in order] + [shares(forest.values, lang_n, v)])

        def priced(a, b):
            (j, x, y), total = forest.walk(a, b)
            return (j, x, y), total, difference(p[a[j], x], p[b[j], y])

        step = max(1, FRONTIER // width)
        for lo in range(0, len(ab), step):
            a, b = ab[lo:lo + step, 0], ab[lo:lo + step, 1]
            _, total, prices = priced(a, b)
            emit(index[a].tolist(), index[b].tolist(), [None] * len(a), total(prices).tolist())
        if low == high:
            for lo in range(0, len(first), step):
                a = np.array(first[lo:lo + step], np.int64)
                b = np.full(len(a), len(order))
                (j, x, y), _, prices = priced(a, b)
                kinds = len(forest.values)
                pairs = (j * kinds + x) * kinds + y
                for r, g in enumerate(a):
                    mine, all_ = forest.leaves[g, :len(names)], forest.leaves[-1, :len(names)]
                    own = np.flatnonzero((forest.values[mine] > 0) & (p[g, mine] > p[-1, all_]))
                    if not len(own):
                        continue
                    f = prices[np.searchsorted(pairs, (r * kinds + mine[own]) * kinds + all_[own])]
                    if len(own) > top:
                        least = np.partition(f, len(f) - top)[len(f) - top]
                        own, f = own[f >= least], f[f >= least]
                    best = sorted(zip((-f).tolist(), [names[t] for t in own]),
                                  key=lambda e: (e[0], e[1].encode()))[:top]
                    emit([order[g]] * len(best), [None] * len(best), [t for _, t in best], [-f for f, _ in best])
    return pa.table([pa.array([lang] * len(out["a"]), pa.string())] + [pa.array(out[c], _BLOCK.field(c).type) for c in out],
                    schema=_BLOCK)


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", *,
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> Audit:
    kept = materialize(kept_counts(docs, lang_col, source_col, text_col, min_docs), "divergence-counts")
    groups = materialize(group_table(kept), "divergence-groups")
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("_c")
    mine = F.expr(f"i div {CHUNK}")
    chunks = [F.least(mine, F.col("_c")).alias("low"), F.greatest(mine, F.col("_c")).alias("high")]
    counts = (kept.filter(F.col("term").isNotNull())
              .join(groups.select("lang", "source", "i", "blocks", "chunks"), ["lang", "source"])
              .withColumn("block", F.pmod(F.xxhash64("term"), "blocks")))
    block_terms = counts.filter("first").groupBy("lang", "block").agg(F.count(F.lit(1)).alias("terms"))
    none = F.lit(0).cast("long")
    counts = (counts.select("lang", "block", "i", "term", "n", "lang_n", none.alias("v"), none.alias("terms"), partner)
              .select("*", *chunks).drop("_c"))
    marks = (groups.select("lang", "i", F.lit(None).cast("string").alias("term"), "n", "lang_n", "v", "blocks", partner)
             .select("*", *chunks).drop("_c")
             .withColumn("block", F.explode(F.sequence(none, F.col("blocks") - 1))).drop("blocks")
             .join(block_terms, ["lang", "block"], "left").withColumn("terms", F.coalesce("terms", none)))

    def price(table: pa.Table) -> pa.Table:
        return _price_block(table, top)

    # work is by cells, not bytes: one partition each, which AQE does not merge
    cells = (groups.filter("i = 0").agg(F.sum(F.col("blocks") * F.col("chunks") * (F.col("chunks") + 1) / 2))
             .first()[0] or 1)
    cell = ["lang", "block", "low", "high"]
    priced = materialize(
        counts.unionByName(marks).repartition(int(min(cells, MAX_PARTITIONS)), *cell).groupBy(*cell)
        .applyInArrow(price, "lang string, a long, b long, term string, value long"), "divergence-prices")
    sums = priced.filter(F.col("b").isNotNull()).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
                             F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    names = groups.select("lang", F.col("i").alias("x"), "source")
    pairs = (sums.select("lang", "value", both.alias("_e")).select("lang", "value", "_e.x", "_e.y")
             .join(names, ["lang", "x"])
             .join(groups.select("lang", F.col("i").alias("y"), F.col("source").alias("other")), ["lang", "y"]))
    terms = (priced.filter(F.col("b").isNull()).select("lang", F.col("a").alias("x"), "term", "value")
             .join(names, ["lang", "x"]))
    return Audit(pairs.select("lang", "source", "other", "value"), terms.select("lang", "source", "term", "value"),
                 groups.select("lang", "source", "docs", "n", "v"))


def audit_rows(found: Audit, top: int = TOP_TERMS) -> DataFrame:
    """Both parts ranked: value descending, item ascending; all pairs, the first ``top`` terms."""
    def ranked(df, part, item):
        best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col(item))
        return df.select("lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value",
                         F.row_number().over(best).alias("rank"))
    return ranked(found.pairs, "pair", "other").unionByName(
        ranked(found.terms, "term", "term").filter(F.col("rank") <= top))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
l AS (SELECT lang, coalesce(any_value(k.v), 0) AS v, coalesce(any_value(k.n), 0) AS n
    FROM d LEFT JOIN (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang) k USING (lang) GROUP BY lang),
g AS (SELECT lang, source, coalesce(any_value(s.n), 0) AS n, any_value(l.v) AS v
    FROM d JOIN l USING (lang) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source) s USING (lang, source)
    GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(c.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (g.n + 2 * g.v)::HUGEINT AS p
    FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT kept.lang, term, 1 + (1000000000::HUGEINT * (c + 2)) // (l.n + 2 * l.v)::HUGEINT AS q FROM kept JOIN l USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS other, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS f
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.other = b.source
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 10
"""
