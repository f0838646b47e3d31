"""Session construction and shared scratch locations.

Streaming checkpoints, published snapshots and lineage cuts are written
below the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (unit tests, a laptop) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Profile for a large cluster (about 1000 executors, 100 TB inputs).  Start with
# many shuffle partitions and let AQE coalesce them towards ~256 MB each; split
# input files at 256 MB; let AQE split skewed join partitions; keep broadcasts
# to sides Catalyst has measured under 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def build_session(master: str | None = None, app: str = "lakeledger",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None, cluster: bool = False) -> SparkSession:
    """A session with our defaults; ``cluster=True`` adds :data:`CLUSTER_CONF`."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints; a local one is set only for a local master."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="lakeledger-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/lakeledger/{name}-{uuid.uuid4().hex[:12]}"
