"""Session helpers: a tuned local session for tests/bench, and the shared folder.

On a cluster the session comes from the caller; nothing here overrides what the
cluster configured. ``shared_dir`` reads ``spark.checkpoint.dir`` and only picks
its own folder when the setting is unset and the master is local (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter for the shredding plans.  AQE coalesces the tiny
# post-dedup partitions and splits skewed ones; the JSON scan splits line files
# by ``maxPartitionBytes``.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "docshred", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session configured like the cluster would be."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("DOCSHRED_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    If the session has none (local tests), create one under the system temp dir
    and register it as the checkpoint dir.  On a non-local master an unset
    setting is an error: a machine-local folder would break on executor loss.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; docshred needs a shared folder "
                "(HDFS/S3/...) for staged documents")
        d = tempfile.mkdtemp(prefix="docshred-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
