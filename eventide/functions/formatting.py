"""Text rendering of a ranked window (the surveyed print format)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The ranking text block of the surveyed jobs.
RANK_HEADER = "=============================="
RANK_TIME_LABEL = "窗口结束时间："
RANK_LINE_PREFIX = "NO "
RANK_LINE_SEP = "："
RANK_FOOTER = "==========================\n\n"
ITEM_LABELS = ("商品ID = ", " 热门度 = ")
PAGE_LABELS = ("页面URL = ", " 浏览量 = ")


def format_ranking(ranked: DataFrame, key: str, labels=ITEM_LABELS, window_end: str = "window_end",
                   rank: str = "rank", count: str = "cnt") -> DataFrame:
    """One text block per window from a top-N result (window_end, rank, key, count).

    The header shows window_end - 1 ms (the last instant inside the window).
    Only the top-N rows of a window are gathered, so the group is bounded by N.
    """
    line = F.concat(F.lit(RANK_LINE_PREFIX), F.col(rank).cast("string"), F.lit(RANK_LINE_SEP),
                    F.lit(labels[0]), F.col(key).cast("string"), F.lit(labels[1]),
                    F.col(count).cast("string"), F.lit("\n"))
    g = ranked.groupBy(window_end).agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), line.alias("l")))).alias("_ls"))
    last_instant = F.col(window_end) - F.expr("INTERVAL 1 MILLISECOND")
    text = F.concat(F.lit(RANK_HEADER), F.lit(RANK_TIME_LABEL),
                    F.date_format(last_instant, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("\n"),
                    F.array_join(F.transform("_ls", lambda s: s["l"]), ""), F.lit(RANK_FOOTER))
    return g.select(window_end, text.alias("text"))
