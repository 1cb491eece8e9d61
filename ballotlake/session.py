"""Session settings shared by tests, bench and the command line."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL settings that decide results or plans, whatever the cluster.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and measurements; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ballotlake")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BALLOTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ballotlake-wh-"))
    )
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a local session that names none gets one of its own; on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        checkpoint = spark.sparkContext.getCheckpointDir()
        base = checkpoint.rsplit("/", 1)[0] if checkpoint else None
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="ballotlake-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, prefix: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_base(spark)}/{prefix}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate files, wherever it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame) -> DataFrame:
    """The rows computed once and written to the shared folder, their lineage cut."""
    spark = df.sparkSession
    base = shared_base(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint(eager=True)
