"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word contracts: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
# Everything in ASCII that is neither a digit nor a lower-case letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Words between white space, in order."""
    return F.array_remove(F.split(text, SPACES, -1), "")


def plain_words(text: Column) -> Column:
    """Words of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII, in order."""
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS, -1), "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. lower() is the quick way where there is nothing but ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def content_key() -> Column:
    """With doc_id, what tells rows of documents apart; equal rows share it."""
    parts = [p for name in ("text", "lang", "source") for p in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(*parts)


def _shared(spark: SparkSession) -> str:
    """The cluster's shared folder; a local session that names none gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="ballotlake-checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# Lets Spark delete a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """The rows computed once and written to the shared checkpoint folder, their lineage cut.

    The shuffle files that led to them are not needed any more and go with the query.
    """
    spark = df.sparkSession
    folder = _shared(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(CLEANUP, before)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{_shared(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate folder, wherever it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """left and right joined on doc_id and content key; a null doc_id meets a null one."""
    other = right.withColumnsRenamed({"doc_id": "_other_id", "_key": "_other_key"})
    match = F.col("doc_id").eqNullSafe(F.col("_other_id")) & (F.col("_key") == F.col("_other_key"))
    return left.join(other, match, how).drop("_other_id", "_other_key")


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs whose (doc_id, _key) is in kept, all columns as they came."""
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", content_key().alias("_key"))
    return join_rows(keyed, kept.select("doc_id", "_key").hint("shuffle_hash"), "left_semi").select("_row.*")
