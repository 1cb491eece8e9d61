"""Voter rows into the raw table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import VOTER_COLUMNS
from ..functions.literals import latest_moment, timestamp_literal
from ..functions.voters import record_hash
from ..operators.dedup import unseen_records
from ..schemas import RAW_VOTERS, RUN_METADATA
from ..session import remove_dir, shared_dir
from ..sources.voter_files import TEXT_COLUMNS, clean_voters, schema_check, unread_cells

IDENTITY = ("source_id", "first_name", "last_name", "email")


class Staged:
    """Voter rows cut, cleaned and written once to the shared folder, and what was found on the way.

    ``warnings`` names text columns without any value, ``unread_cells`` counts cells that said something
    but could not be read. As a context it removes the folder at its end.
    """

    def __init__(self, text: DataFrame) -> None:
        self._spark = text.sparkSession
        self._folder = shared_dir(self._spark, "staged-voters")
        seen = Observation("staged")
        cleaned = clean_voters(text.withColumn("_text", F.struct(*VOTER_COLUMNS)))
        lost = unread_cells({c: F.col("_text")[c] for c in VOTER_COLUMNS}, {c: F.col(c) for c in VOTER_COLUMNS})
        counted = cleaned.withColumn("_lost", lost).observe(seen, F.sum("_lost").alias("lost"))
        counted.drop("_text", "_lost").write.parquet(self._folder)
        self.rows = self._spark.read.parquet(self._folder)
        self.unread_cells = seen.get["lost"] or 0
        notes = schema_check(self.rows.select(*VOTER_COLUMNS), text=TEXT_COLUMNS).where("note IS NOT NULL").collect()
        self.warnings = tuple(f"{row.column_name}: {row.note}" for row in notes)

    def __enter__(self) -> Staged:
        return self

    def __exit__(self, *_: object) -> None:
        remove_dir(self._spark, self._folder)


def raw_records(cleaned: DataFrame, as_of: datetime) -> DataFrame:
    """Cleaned voter rows in the raw table's columns; ``file_order`` is kept when present."""
    rows = cleaned.withColumnRenamed("id", "source_id")
    if "source_file" not in rows.columns:
        rows = rows.withColumn("source_file", F.lit(None).cast("string"))
    stamped = rows.withColumns(
        {
            "record_uuid": F.expr("uuid()"),
            "record_hash": record_hash(*[F.col(c) for c in IDENTITY]),
            "inserted_at": timestamp_literal(as_of),
            "updated_at": timestamp_literal(as_of),
        }
    )
    extra = ["file_order"] if "file_order" in rows.columns else []
    return stamped.select(*RAW_VOTERS.columns, *extra)


def ingest_voters(
    cleaned: DataFrame, as_of: datetime, existing: DataFrame | None = None, truncate: bool = False
) -> DataFrame:
    """The rows a run adds to the raw table.

    A record is the person (id, names, email): one already stored, or met in an earlier
    file of the run, is left out; repeats inside one file pass. ``truncate`` (the table is
    emptied first) keeps every row.
    """
    records = raw_records(cleaned, as_of)
    if not truncate:
        order = "file_order" if "file_order" in records.columns else None
        records = unseen_records(records, existing, "record_hash", order)
    return records.select(*RAW_VOTERS.columns)


def ingest_metrics(raw: DataFrame) -> DataFrame:
    """Distinct voters and states of the raw table, nulls left out."""
    return raw.agg(
        F.count_distinct("source_id").alias("voter_count"), F.count_distinct("state").alias("state_count")
    )


def run_metadata(
    previous: DataFrame | None, metrics: DataFrame, as_of: datetime, files: int, records: int | DataFrame
) -> DataFrame:
    """The single row of run statistics; the creation time of an earlier row is kept."""
    now = timestamp_literal(as_of)
    count = records.agg(F.count(F.lit(1)).alias("n")).scalar() if isinstance(records, DataFrame) else F.lit(records)
    created = now
    if previous is not None:
        created = F.coalesce(previous.where("id = 1").agg(F.max("created_at")).scalar(), now)
    return metrics.select(
        F.lit(1).alias("id"),
        now.alias("last_processed_at"),
        F.lit(files).cast("int").alias("files_processed"),
        count.cast("int").alias("records_processed"),
        F.col("voter_count").cast("int").alias("voter_count"),
        F.col("state_count").cast("int").alias("state_count"),
        created.alias("created_at"),
        now.alias("updated_at"),
    ).select(*RUN_METADATA.columns)


def last_watermark(metadata: DataFrame | None, fallback: datetime | None = None) -> datetime | None:
    """When the newest recorded run took place (UTC); ``fallback`` without one."""
    if metadata is None:
        return fallback
    newest = metadata.orderBy(F.desc("id")).limit(1)
    return latest_moment(newest, "last_processed_at") or fallback
