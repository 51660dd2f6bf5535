"""Session helpers: building a session for local runs, and the shared
scratch folder every job writes its intermediate tables to.

On a cluster the scratch folder is the one the cluster names in
``spark.checkpoint.dir`` (a shared file system). Only when that is unset,
as in a bare local test session, do we make one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, *, app: str = "quarry",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings the engine is designed around.

    Adaptive execution re-plans at run time: it coalesces small shuffle
    partitions, splits skewed join partitions and skewed REBALANCE
    partitions (used by day-partitioned writes). ``shuffle_partitions``
    should be sized so one partition is ~128-256 MB at the target scale;
    AQE then only ever merges.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables (``spark.checkpoint.dir``).

    Set only when unset, and only on a ``local[...]`` master (tests): on a
    cluster a machine-local folder would be lost with its machine, so an
    unset folder is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that "
                               "the driver and all executors share")
        spark.sparkContext.setCheckpointDir(
            tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp")))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never-used folder under the scratch root."""
    return f"{scratch_root(spark)}/quarry/{label}-{uuid.uuid4().hex[:12]}"
