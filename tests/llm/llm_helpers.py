"""Fixtures shared by the tests of the training-data operators."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])
#: Columns whose names the operators use inside.
CLASH = ["_k", "_n", "_t", "_row", "sig", "th", "k", "rank", "score", "size", "line", "leaf", "taken", "class_id", "stratum"]


def make_docs(spark, rows, clash=False):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] or ("en", "src")), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOC)
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASH)}) if clash else df


WORDS = [f"w{i}{'abcdefghij'[i % 10]}" for i in range(400)]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


#: nulls in any column, empty and blank texts, repeated rows, repeated ids, a long text.
EDGE = [(1, None), (2, ""), (3, " \t\n "), (None, "one two three four five six seven"), (4, "a b c"), (4, "a b c"),
        (5, "x"), (5, "y z"), (6, "tail\n\nline one two three four five six\nline one two three four five six"),
        (7, "lorem ipsum " * 30000, None, None), (None, None, None, None)]
