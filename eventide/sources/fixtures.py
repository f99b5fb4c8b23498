"""Fixture views ``fx_*`` derived from the driver tables (nothing is written).

Each view re-shapes ``events`` / ``orders`` / ``nation`` into the record
shape one surveyed job consumes.  Everything is a projection (plus one join
with the 25-row ``nation`` dimension), so scans keep column pruning and
predicate pushdown.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.timeutil import epoch_micros, plus_seconds, ts_type

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Fixtures:
    """Lazily built fixture DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def _k() -> F.Column:
        return F.col("_k")

    def _events_k(self, generator: bool = False) -> DataFrame:
        """events plus the JSON key ``k`` as ``_k``.

        ``generator=True`` parses it with ``json_tuple``: a generator output is a real
        column, so filters on columns derived from ``k`` (method, url) stay above it
        instead of being rewritten into one JSON parse per predicate.  Views whose
        filters only touch plain columns (event_type) keep ``get_json_object`` so those
        filters still reach the parquet scan."""
        e = self.table("events")
        if not generator:
            return e.withColumn("_k", F.get_json_object("props", "$.k").cast("int"))
        cols = [c for c in e.columns if c != "props"]
        return e.select(*cols, F.json_tuple("props", "k").alias("_ks")).withColumn(
            "_k", F.col("_ks").cast("int")).drop("_ks")

    @cached_property
    def user_behavior(self) -> DataFrame:
        k = self._k()
        behavior = (F.when(F.col("event_type") == "view", "pv")
                    .when(F.col("event_type") == "purchase", "buy")
                    .when(F.col("event_type") == "click", "cart")
                    .otherwise("fav"))
        return self._events_k().select(
            F.col("event_id").alias("seq"), "user_id", k.cast("bigint").alias("item_id"),
            (k % 10).cast("int").alias("category_id"), behavior.alias("behavior"), "ts")

    @cached_property
    def access_log(self) -> DataFrame:
        k = self._k()
        suffix = (F.when(k % 6 == 0, ".css").when(k % 6 == 1, ".png")
                  .when(k % 6 == 2, ".css?v=1").otherwise(""))
        return self._events_k(generator=True).select(
            F.col("event_id").alias("seq"),
            F.concat(F.lit("10.0."), (F.col("user_id") % 16).cast("string"), F.lit("."),
                     k.cast("string")).alias("ip"),
            F.col("user_id").cast("string").alias("user_id"), "ts",
            F.when(k % 10 == 0, "POST").otherwise("GET").alias("method"),
            F.concat(F.lit("/p/"), (k % 20).cast("string"), suffix).alias("url"))

    @cached_property
    def access_log_arrivals(self) -> DataFrame:
        """The access log with an order of arrival (epoch microseconds): most rows arrive at their own time, some 20
        minutes, some six hours after it."""
        after = (F.when(F.col("seq") % 7 == 0, 21600).when(F.col("seq") % 5 == 0, 1200).otherwise(0)).cast("bigint")
        at = epoch_micros("ts", ts_type(self.access_log, "ts")) + after * 1_000_000
        return self.access_log.withColumn("arrival", at)

    @cached_property
    def marketing(self) -> DataFrame:
        et = F.col("event_type")
        behavior = (F.when(et == "click", "CLICK").when(et == "signup", "DOWNLOAD")
                    .when(et == "purchase", "INSTALL").when(et == "error", "UNINSTALL"))
        m = F.col("user_id") % 3
        channel = F.when(m == 0, "app store").when(m == 1, "wechat").otherwise("weibo")
        return self.table("events").select(
            F.col("event_id").alias("seq"), "user_id", behavior.alias("behavior"),
            channel.alias("channel"), "ts")

    @cached_property
    def ad_click(self) -> DataFrame:
        k = self._k()
        e = (self._events_k().filter(F.col("event_type").isin("click", "view", "purchase"))
             .select("event_id", "user_id", "_k", "ts"))
        n = self.table("nation").select("n_nationkey", "n_name")
        # nation is a fixed 25-row dimension; the planner broadcasts it by its
        # measured size (autoBroadcastJoinThreshold), no hint needed.
        j = e.join(n, n.n_nationkey == (e.user_id % 25).cast("int"))
        return j.select(
            F.col("event_id").alias("seq"), "user_id", (k % 3).cast("bigint").alias("ad_id"),
            F.col("n_name").alias("province"),
            F.concat(F.lit("city"), (k % 7).cast("string")).alias("city"), "ts")

    @cached_property
    def login(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("seq"), "user_id",
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
            F.when(F.col("event_type").isin("error", "signup"), "fail").otherwise("success")
            .alias("login_state"), "ts")

    # order / receipt offsets (seconds after o_orderdate), fixed by the fixture spec
    @staticmethod
    def _offsets():
        k = F.col("o_orderkey")
        c = (k * 7919) % 80000
        p = c + (k * 13) % 1801 - 60
        r = p + (k * 17) % 15 - 7
        return c, p, r

    @cached_property
    def order_events(self) -> DataFrame:
        c, p, _ = self._offsets()
        o = self.table("orders").select("o_orderkey", "o_orderdate")
        k = F.col("o_orderkey")
        # some creates are missing, but only where the pay exists: no order is lost altogether
        creates = o.filter((k % 11 != 0) | (k % 5 == 0)).select(
            (k * 2).alias("seq"), k.alias("order_id"), F.lit("create").alias("event_type"),
            F.lit("").alias("tx_id"), plus_seconds("o_orderdate", c).alias("ts"))
        pays = o.filter(k % 5 != 0).select(
            (k * 2 + 1).alias("seq"), k.alias("order_id"), F.lit("pay").alias("event_type"),
            F.concat(F.lit("tx"), k.cast("string")).alias("tx_id"),
            plus_seconds("o_orderdate", p).alias("ts"))
        return creates.unionByName(pays)

    @cached_property
    def receipts(self) -> DataFrame:
        _, _, r = self._offsets()
        k = F.col("o_orderkey")
        return (self.table("orders").select("o_orderkey", "o_orderdate").filter(k % 7 != 0)
                .select(F.concat(F.lit("tx"), k.cast("string")).alias("tx_id"),
                        F.when(k % 2 == 0, "alipay").otherwise("wechat").alias("pay_channel"),
                        plus_seconds("o_orderdate", r).alias("ts")))
