"""Session defaults and the shared checkpoint folder.

Cluster settings (shuffle partitions, memory, checkpoint dir) come from the
cluster; ``builder`` only fills in what is unset, for tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def builder(master: str | None = None, shuffle_partitions: int | None = None,
            app: str = "txnwatch") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (builder(f"local[{cores}]", shuffle_partitions)
             .config("spark.driver.memory", os.environ.get("TXNWATCH_DRIVER_MEMORY", "8g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when a local session (tests, the bench) has none, a scratch folder is
    created and set; on a cluster the setting is needed, as executors do not share local folders.
    """
    sc = spark.sparkContext
    cur = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not cur and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not cur:
        cur = tempfile.mkdtemp(prefix="txnwatch-ckpt-", dir="/tmp")
    sc.setCheckpointDir(cur)
    return sc.getCheckpointDir() or cur
