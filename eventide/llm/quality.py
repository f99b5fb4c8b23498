"""Operator 1: quality rules with risk-controlled thresholds.

Every document is measured; a base rule rejects very short and self-repeating texts.  On top stand rules of the
form "reject when the measure exceeds the cutoff".  Cutoffs are chosen from labelled holdout rows, per stratum
(language): on the good documents of a stratum, the number rejected by a cutoff is binomial; a cutoff is certified
when the exact binomial tail P(X <= seen | n, limit) is at most its error level, i.e. when the exact upper bound of
its false rejection rate is below ``limit``.  Within a rule cutoffs are tested from mild to strict and testing
stops at the first failure (fixed sequence, no correction needed inside it); across rules and strata the error
level ``delta`` is divided by their number (Bonferroni), and the allowed rate ``alpha`` of a stratum is divided by
the number of rules.  So with probability 1 - delta, no stratum loses more than ``alpha`` of its good documents to
these rules.  A stratum with too few labels certifies nothing and rejects nothing.

Scale: documents are measured once, in the tasks that read them, into a narrow table; the thresholds use all
labelled rows through counts per (stratum, rule, cutoff), which are pre-aggregated.

Defined cases: null text or no words: zero measures, base_failed; null strata form one stratum; null ids match no
label; rows with a repeated id count each with that id's label (good if any label says good); labels with a null
quality are ignored; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import SPACES, materialize, words

#: Fixed value of the contract.
SYMBOLS = "#*$%&|<>"
UPPER = re.compile("[A-ZÀ-ÖØ-Þ]+")  # upper-case Latin letters
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines"]
#: Rules: measure of a document (SQL over MEASURES, n_words > 0) and its cutoffs from mild to strict.
RULES = {
    "symbols": ("n_symbols / n_words", [2.0, 1.0, 0.5, 0.25, 0.1, 0.05]),
    "dup_lines": ("n_dup_lines / n_lines", [0.8, 0.6, 0.5, 0.4, 0.3, 0.2]),
    "repeat_words": ("n_repeat_words / n_words", [0.18, 0.15, 0.12, 0.1, 0.08, 0.05]),
    "upper": ("n_upper / word_chars", [0.9, 0.7, 0.5, 0.3, 0.2]),
    "marks": ("n_marks / n_words", [2.0, 1.0, 0.5, 0.25, 0.1]),
    "long_words": ("word_chars / n_words", [20.0, 15.0, 12.0, 11.0, 10.0]),
}


def repeated_words(ids: np.ndarray, width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more (first occurrence included), exactly."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    key = np.zeros(n, np.uint64)
    for j in range(width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[j:n + j]
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    a, b = order[1:][same], order[:-1][same]
    if any((ids[a + j] != ids[b + j]).any() for j in range(width)):  # two windows with one key: compare them whole
        seen = defaultdict(list)
        for i in range(n):
            seen[tuple(ids[i:i + width])].append(i)
        starts = np.array([i for v in seen.values() if len(v) > 1 for i in v], np.int64)
    else:
        starts = np.concatenate([a, b])
    mark = np.zeros(len(ids) + 1, np.int64)
    begin = np.unique(starts)
    np.add.at(mark, begin, 1)
    np.add.at(mark, begin + width, -1)
    return int((np.cumsum(mark)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(MEASURES)
    tokens = words(text)
    numbers = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, tokens), np.uint64, len(tokens))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    chars = len(text) - sum(map(text.count, SPACES))
    upper = sum(map(len, UPPER.findall(text)))
    return (len(tokens), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(ids), upper, text.count("!") + text.count("?"), len(lines))


def _measure_batches(batches):
    for b in batches:
        rows = [measure(t.as_py()) for t in b.column(2)]
        cols = list(zip(*rows)) if rows else [[] for _ in MEASURES]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in cols)],
                                         ["doc_id", "stratum", *MEASURES])


def measures(docs: DataFrame, id_col="doc_id", text_col="text", stratum_col="lang") -> DataFrame:
    schema = "doc_id long, stratum string, " + ", ".join(f"{m} long" for m in MEASURES)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                       F.col(text_col).alias("text")).mapInArrow(_measure_batches, schema)


def binomial_tail(seen: int, n: int, rate: float) -> float:
    """P(X <= seen) for X ~ Binomial(n, rate), summed in logs."""
    if seen >= n:
        return 1.0
    k = np.arange(seen + 1, dtype=np.float64)
    steps = np.log((n - k[1:] + 1) / k[1:]) + math.log(rate) - math.log1p(-rate)
    logs = n * math.log1p(-rate) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def certified(cutoffs, rejected, n: int, limit: float, level: float):
    """The strictest cutoff that passes before the first failure (None: none does)."""
    best = None
    for c, k in zip(cutoffs, rejected):
        if binomial_tail(int(k), int(n), limit) > level:
            break
        best = c
    return best


def _base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def select_cutoffs(measured: DataFrame, labels: DataFrame, label_id="doc_id", label_col="quality", *,
                   alpha: float = 0.05, delta: float = 0.1, rules=RULES) -> DataFrame:
    """One row per stratum: n_good and a nullable cutoff per rule."""
    good = (labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(label_id).cast("long").alias("doc_id"))
            .agg(F.max(label_col).alias("_q")).filter("_q = 1").select("doc_id"))
    held = measured.join(good, "doc_id").filter(~_base_failed())
    sums = [F.sum((F.expr(f"double({what})") > F.lit(c)).cast("long")).alias(f"{r}_{i}")
            for r, (what, cuts) in rules.items() for i, c in enumerate(cuts)]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *sums)
    strata = measured.select("stratum").distinct().agg(F.count(F.lit(1)).alias("_n_strata"))
    counts = counts.crossJoin(strata)  # one row

    def choose(frames):
        for f in frames:
            out = pd.DataFrame({"stratum": f.stratum.astype(object), "n_good": f.n_good})
            for r, (_, cuts) in rules.items():
                out[f"cut_{r}"] = [certified(cuts, [row[f"{r}_{i}"] for i in range(len(cuts))], row["n_good"],
                                             alpha / len(rules), delta / (len(rules) * row["_n_strata"]))
                                   for row in f.to_dict("records")]
                out[f"cut_{r}"] = out[f"cut_{r}"].astype("float64")
            yield out

    schema = "stratum string, n_good long, " + ", ".join(f"cut_{r} double" for r in rules)
    return counts.mapInPandas(choose, schema)


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", stratum_col="lang", *,
                     alpha: float = 0.05, delta: float = 0.1, rules=RULES) -> DataFrame:
    """doc_id, the measures, base_failed, kept and the names of the rules that reject the document."""
    measured = materialize(measures(docs, id_col, text_col, stratum_col), "quality")
    cuts = materialize(select_cutoffs(measured, labels, alpha=alpha, delta=delta, rules=rules), "quality-cutoffs")
    cuts = cuts.withColumnRenamed("stratum", "_stratum").drop("n_good")
    joined = measured.join(cuts, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    failed = [F.when(F.expr(f"n_words > 0 and double({what}) > cut_{r}") & ~F.isnan(f"cut_{r}"), F.lit(r))
              for r, (what, _) in rules.items()]
    return joined.select("doc_id", "stratum", *MEASURES, _base_failed().alias("base_failed"),
                         F.filter(F.array(*failed), lambda x: x.isNotNull()).alias("failed_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
