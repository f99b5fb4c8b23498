import re

from eventide.llm import linededup
from eventide.llm.common import WORD_PATTERN
from pyspark.sql import functions as F

LINES = ["a b c d e", " a \t b\x0b\x0cc\r d  e f  ", " x y z q r s \x1ft", "to be or not to be or not to be",
         " ".join(f"w{i % 23}" for i in range(90))]


def frame(spark):
    return spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "k1 long, line string")


def test_words_are_those_of_the_contract(spark):
    got = frame(spark).select("k1", linededup._words(F.col("line")).alias("w")).collect()
    assert {r.k1: r.w for r in got} == {i: re.findall(WORD_PATTERN, x) for i, x in enumerate(LINES)}


def test_the_screen_enters_a_lines_first_shingles_once(spark):
    entered = linededup._prefix(frame(spark), 5, 4, 5)
    got = {}
    for r in entered.collect():
        got.setdefault((r.k1, r.least), []).append(r.t)
    for i, x in enumerate(LINES):
        w = re.findall(WORD_PATTERN, x)
        n, order = len(w) - 4, sorted(set(w[:len(w) - 4]), key=str.encode)
        last = order[min(n - -(-n * 4 // 5) + 1 + n // 20, len(order)) - 1].encode()
        least = -(-len(order) * 4 // 5) // 20 + 1
        taken = sorted({tuple(w[j:j + 5]) for j in range(n) if w[j].encode() <= last})
        want = spark.createDataFrame([(list(t),) for t in taken], "t array<string>").select(
            F.xxhash64(*[F.get("t", F.lit(j)) for j in range(5)]).alias("h")).collect()
        assert sorted(got[i, least]) == sorted(r.h for r in want)
