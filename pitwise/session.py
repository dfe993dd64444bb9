"""Spark session helpers.

The library itself never creates a session: every operator takes DataFrames.
`local_session` is for tests and the bench; on a cluster the caller's session
is used as is, and `checkpoint_dir` only reads what the cluster configured.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library relies on (time semantics are UTC).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Suggested settings for a large cluster (100 TB class inputs). The initial shuffle
# partition count is high on purpose: AQE coalesces small partitions at run time
# toward the advisory size, splits skewed join partitions, and turns joins into
# broadcasts only when the measured side is under the threshold.
CLUSTER_CONF = {
    **REQUIRED_CONF,
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply the runtime-settable part of CLUSTER_CONF (and `overrides`) to a session."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    `spark.checkpoint.dir` is read from the session, else the folder the caller has
    registered is used. With neither, a scratch folder is created and registered on a
    local master only: the executors of a cluster would not share it, so that raises.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="pitwise-ckpt-", dir=os.environ.get("PITWISE_SCRATCH", "/tmp"))
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate written tables."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/" + name


def unique_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder; the caller owns what it writes there."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_WRITTEN: list[str] = []


def new_scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder that `drop_scratch` deletes."""
    _WRITTEN.append(unique_path(spark, name))
    return _WRITTEN[-1]


def materialize(df, name: str = "stage"):
    """Write `df` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like `checkpoint()`, but computes the plan a single time (a
    reliable RDD checkpoint of an unpersisted plan recomputes it to write the files)
    and survives the loss of any executor.
    """
    path = new_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete folders on any Hadoop file system; returns the number deleted."""
    n = 0
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def drop_scratch(spark: SparkSession) -> int:
    """Delete everything under the paths of `new_scratch` and `materialize` of this process; returns the number deleted.

    For the caller to use once the results that read them have been written.
    """
    paths = list(_WRITTEN)
    _WRITTEN.clear()
    return delete_paths(spark, paths)
