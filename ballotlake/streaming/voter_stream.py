"""Voter files as a stream: each file is loaded once, by any number of runs.

The stream's checkpoint remembers the files already seen, in place of a watermark. A batch's files
pass the same gate and are read by the same header-aware reader as those of a batch run; its rows are cut
and cleaned once and checked like those of a run.

The raw table is stored by batch and, within a batch, by a hash of the record's key. A batch looks its keys up
only in the key partitions they fall in.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..plans.ingest import Staged, ingest_voters, raw_records
from ..schemas import RAW_VOTERS
from ..sources.voter_files import file_lines, read_voter_lines

STORED = (StructField("batch_id", LongType()), StructField("key_part", IntegerType()))
# Partitions of a batch by key: more make a small batch open less, and a large one write more files.
KEY_PARTS = 64


@dataclass(frozen=True)
class Batch:
    """What one batch of the stream did."""

    batch_id: int
    new_records: int
    # Text columns without any value, and cells that said something but could not be read.
    warnings: tuple[str, ...] = field(default=(), compare=False)
    unread_cells: int = field(default=0, compare=False)


def key_part(key: Column | str) -> Column:
    """The partition of a record's key; records without one have a partition too."""
    return F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).cast("int")


def read_raw(spark: SparkSession, path: str) -> DataFrame | None:
    """The raw table the stream writes, or None before its first batch."""
    try:
        return spark.read.schema(StructType([*RAW_VOTERS.schema, *STORED])).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stored_for(stored: DataFrame, records: DataFrame, batch_id: int) -> DataFrame:
    """The stored rows of other batches that a record's key may be among: whole partitions are left out."""
    parts = [row[0] for row in records.select(key_part("record_hash")).distinct().collect()]  # KEY_PARTS at most
    return stored.where((F.col("batch_id") != batch_id) & F.col("key_part").isin(parts))


def ingest_stream(
    spark: SparkSession,
    folder: str,
    raw_path: str,
    checkpoint: str,
    as_of: datetime,
    max_files: int | None = None,
) -> list[Batch]:
    """Load the folder's unseen files into the raw table, then stop; tells what each batch did.

    Every batch overwrites a partition of its own, so one that is repeated after a failure
    leaves no row twice. A file that fails the gate stops the stream before its batch is written.
    """
    done: list[Batch] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stored, seen = read_raw(session, raw_path), Observation("batch")
        with Staged(read_voter_lines(batch)) as staged:
            existing = None if stored is None else stored_for(stored, raw_records(staged.rows, as_of), batch_id)
            rows = ingest_voters(staged.rows, as_of, existing).observe(seen, F.count(F.lit(1)).alias("rows"))
            # A partition's rows come together; those of a frequent key may still be split over tasks.
            placed = rows.withColumn("key_part", key_part("record_hash")).hint("rebalance", F.col("key_part"))
            placed.write.mode("overwrite").partitionBy("key_part").parquet(f"{raw_path}/batch_id={batch_id}")
        done.append(Batch(batch_id, seen.get["rows"], staged.warnings, staged.unread_cells))

    reader = spark.readStream.option("pathGlobFilter", "*.csv")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    (
        file_lines(reader.text(folder))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return done
