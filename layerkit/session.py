"""Session construction and the shared workspace folder for written tables."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the jobs are tuned for. AQE re-plans joins from real shuffle
# sizes (a size-checked broadcast with sort-merge as the fallback), splits skewed
# join partitions and coalesces small ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Starting point for a large cluster (hundreds of executors, ~100 TB inputs):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, 256 MB scan
# splits, skew splitting above 5x the median partition, and a broadcast limit that
# is checked against real (runtime) sizes by AQE.
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    # coalesce to the advisory size rather than keeping default parallelism
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "layerkit", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession) -> str:
    """Shared folder for tables and checkpoints: the cluster's ``spark.checkpoint.dir``.

    Only a session on one machine (``local`` / ``local[n]``) may have none: a private
    folder is created there and registered as the checkpoint directory. On a cluster
    executors would not see it, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext  # absent on Spark Connect sessions
    except Exception:  # noqa: BLE001
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else ""
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="layerkit-ws-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused folder under the workspace for one job run."""
    return f"{workspace(spark)}/layerkit/{tag}-{uuid.uuid4().hex[:12]}"


def new_database(spark: SparkSession, tag: str) -> str:
    """Create a catalog database located in a fresh run folder; returns its name."""
    name = f"{tag}_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{new_run_dir(spark, tag)}'")
    return name
