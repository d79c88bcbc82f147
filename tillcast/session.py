"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes (broadcast
# only when the measured side is below the threshold, sort-merge otherwise), splits
# skewed shuffle partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tillcast",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor.
        conf["spark.driver.memory"] = os.environ.get("TILLCAST_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared filesystem every executor
    and the driver can read). Only on a local master - tests - is a scratch folder
    picked when it is unset; on any other master an unset folder is an error, because
    a machine-local folder would not be seen by the other executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir is unset on master {master}: name a shared folder")
        path = tempfile.mkdtemp(prefix="tillcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession) -> str:
    """Folder of this application's staged tables inside the shared checkpoint folder.

    One folder per application, so whoever owns the checkpoint folder can delete the
    folders of finished applications (the name carries the application id).
    """
    return f"{checkpoint_dir(spark)}/tillcast-{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under ``run_dir`` and read it back: a cut in the
    lineage that survives lost executors, and a table several later passes can share."""
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cluster_conf(total_cores: int, input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Partition sizing for a cluster run (pass as ``get_session(extra=...)``).

    Scans split at ~256 MB; the initial shuffle width is large enough that no
    partition exceeds the target even before AQE (at least 3 tasks per core), and
    AQE then coalesces small partitions to the advisory size and splits skewed ones
    (a partition 5x the median and above the target). For 100 TB on 1000 executors
    x 8 cores this gives ~400k initial shuffle partitions, coalesced at runtime.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
    }
