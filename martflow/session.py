"""Session construction and the shared scratch folder.

The cluster names a shared folder in ``spark.checkpoint.dir``; every
materialisation that must survive executor loss (stream checkpoints, landing
files written by tests, lineage cuts) goes below it.  A folder is only created
here when the setting is missing, which is the local/test case.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults that matter at scale.  AQE re-plans joins from runtime sizes
# (a dimension turns into a broadcast only after its real size was measured),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "martflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when a session with a local master has none (tests) is one created
    under the system temp folder and registered, so later calls agree; on a
    cluster the executors could not see such a folder, so it must be named.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="martflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def cut_lineage(df):
    """Reliable checkpoint below ``spark.checkpoint.dir`` (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, "martflow", f"{purpose}-{uuid.uuid4().hex[:12]}")
