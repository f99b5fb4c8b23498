"""Session helpers.

Cluster jobs read ``spark.checkpoint.dir`` from the session (a shared,
fault-tolerant folder named by the cluster).  Only when it is unset, as in
local tests, a scratch folder is created and registered.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "eventide",
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if _single_machine(spark):
        checkpoint_dir(spark)
    return spark


def _single_machine(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; a scratch one is made only if unset and on one machine."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d and not _single_machine(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="eventide-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core conf may be read-only at runtime; the context dir below suffices
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
