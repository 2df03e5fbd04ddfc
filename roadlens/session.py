"""Session and shared-folder helpers.

This module builds a session for tests and benchmarks and locates the shared
folder used to cut lineage (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "roadlens", extra: dict | None = None) -> SparkSession:
    """A session tuned for this library: AQE on, UTC, UI off."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a distributed file
    system path); unset, it is an error there. Only in local mode is a private
    folder made and registered, so ``DataFrame.checkpoint()`` works as well.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="roadlens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    try:  # classic sessions: also let DataFrame.checkpoint() use the folder
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(os.path.join(configured, "rdd"))
    except Exception:  # remote sessions have no SparkContext
        pass
    return configured


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever file system it is; false if it was not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> int:
    """Remove the tables that this application wrote in the shared folder; returns how many there were.

    Call it when no DataFrame that reads them is needed any more.
    """
    paths, _SCRATCH[:] = list(_SCRATCH), []
    return sum(remove_path(spark, path) for path in paths)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the table instead of
    recomputing the source) and lets later size checks read file metadata.
    Unlike an RDD checkpoint, the input is computed only once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
