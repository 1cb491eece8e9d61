"""Writing tables and files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import Contract
from .quality import ContractError, check_columns, enforce_contract


# Behind the name of files that are about to be replaced.
ASIDE = ".before"


def csv_sink(df: DataFrame, path: str) -> bool:
    """Write the rows as CSV files with a header; an empty dataset is refused (False).

    The rows are counted while they are written beside ``path`` and take its place after that, so
    they are computed once and a refused dataset leaves what was there. The old files stand aside until
    the new ones are in place; ``latest_csv`` finds them there if the job is lost between the two steps.
    """
    spark = df.sparkSession
    seen = Observation("csv")
    plain = path.rstrip("/")
    target, beside, aside = (
        spark._jvm.org.apache.hadoop.fs.Path(name) for name in (plain, f"{plain}.{uuid.uuid4().hex}", plain + ASIDE)
    )
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.option("header", "true").option("escape", '"').csv(beside.toString())
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not seen.get["rows"]:
        files.delete(beside, True)
        return False
    if files.exists(target):
        # What stands aside is older than the target, and not needed beside it.
        files.delete(aside, True)
        _rename(files, target, aside)
    try:
        _rename(files, beside, target)
    except OSError:
        if files.exists(aside):
            files.rename(aside, target)
        raise
    files.delete(aside, True)
    return True


def _rename(files: JavaObject, source: JavaObject, target: JavaObject) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def latest_csv(spark: SparkSession, path: str) -> str:
    """Where the files last written to ``path`` are: there, or aside if a later write was cut off."""
    plain = path.rstrip("/")
    here, aside = (spark._jvm.org.apache.hadoop.fs.Path(name) for name in (plain, plain + ASIDE))
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    return plain + ASIDE if files.exists(aside) and not files.exists(here) else path


def save_table(df: DataFrame, name: str, key: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write a table; with ``key`` it is bucketed, so later joins and counts by key need no shuffle.

    With as many buckets as shuffle partitions, rows that come out of a join or aggregate by
    the key already are together as the buckets want them. Otherwise they are brought
    together first, so that a task does not write a file for every bucket.
    """
    bucketed = bool(key and buckets)
    if bucketed and buckets != int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(buckets, key)
    writer = df.write.mode("overwrite").format("parquet")
    if bucketed:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def publish(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    contract: Contract | None = None,
    waived: Sequence[str] = (),
    key: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Write ``df`` as the next version of ``name`` and point the view ``name`` at it.

    The new version may be computed from the current one. Column types are checked before
    the write, the contract's other constraints on the written rows before the view moves;
    readers see the old table until then, and a failure leaves it in place. One earlier
    version is kept.
    """
    if contract is not None:
        check_columns(df, contract)
    database, _, table = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__v*'").collect()
    versions = sorted(int(r.tableName.rsplit("__v", 1)[1]) for r in found)
    version = f"{database}.{table}__v{versions[-1] + 1 if versions else 1}"
    written = save_table(df, version, key, buckets)
    if contract is not None:
        try:
            enforce_contract(written, contract, waived)
        except ContractError:
            spark.sql(f"DROP TABLE {version}")
            raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in versions[:-1]:
        spark.sql(f"DROP TABLE {database}.{table}__v{old}")
    return spark.table(name)


def current(spark: SparkSession, name: str) -> DataFrame | None:
    """The table's current version, or None before the first one."""
    return spark.table(name) if spark.catalog.tableExists(name) else None
