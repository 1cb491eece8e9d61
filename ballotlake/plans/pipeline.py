"""Whole runs: voter files to marts, and election files to calendars."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.quality import run_checks
from ..operators.sinks import csv_sink, current, publish
from ..sources.election_files import load_seed, scan_civic_json, scan_results_tsv
from ..sources.voter_files import new_file_paths, read_voter_files
from . import calendars, checks, marts
from .ingest import Staged, ingest_metrics, ingest_voters, last_watermark, run_metadata
from .voters import dim_upsert, stage_upsert

# Names may be missing in the dimension: no rule drops such voters. The check report tells.
NULLABLE_NAMES = ("first_name", "last_name")


@dataclass(frozen=True)
class Run:
    """What one ingest run did."""

    files: int
    new_records: int
    voter_count: int
    state_count: int
    # Text columns without any value, and cells that said something but could not be read.
    warnings: tuple[str, ...] = field(default=(), compare=False)
    unread_cells: int = field(default=0, compare=False)


def load_voters(
    spark: SparkSession,
    folder: str,
    database: str,
    as_of: datetime,
    truncate: bool = False,
    fallback: datetime | None = None,
    buckets: int | None = None,
) -> Run:
    """Load the folder's files newer than the last run into ``database.vote_records``.

    With ``truncate`` the table is replaced by the new files' rows. A rejected file stops
    the run before anything is written. ``fallback`` is the watermark where no run is recorded.
    The table is bucketed by ``record_hash``, so that the next run finds stored records without
    moving them.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    raw_name, meta_name = f"{database}.vote_records", f"{database}.processing_metadata"
    metadata = current(spark, meta_name)
    since = last_watermark(metadata, fallback)
    paths = new_file_paths(spark, folder, since)
    if not paths:
        if truncate and spark.catalog.tableExists(raw_name):
            spark.sql(f"TRUNCATE TABLE {raw_name}")
        return Run(0, 0, 0, 0)
    seen = Observation("ingest")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with Staged(read_voter_files(spark, paths)) as staged:
        existing = None if truncate else current(spark, raw_name)
        added = ingest_voters(staged.rows, as_of, existing, truncate).observe(
            seen, F.count(F.lit(1)).alias("rows")
        )
        # Together by key for the buckets; a frequent key's rows may still be split over tasks.
        writer = added.hint("rebalance", F.col("record_hash")).write.mode("overwrite" if truncate else "append")
        writer.format("parquet").bucketBy(buckets, "record_hash").sortBy("record_hash").saveAsTable(raw_name)
    metrics = ingest_metrics(spark.table(raw_name))
    records = seen.get["rows"]
    publish(
        spark, run_metadata(metadata, metrics, as_of, len(paths), records), meta_name, schemas.RUN_METADATA
    )
    stats = spark.table(meta_name).first()
    return Run(
        len(paths), records, stats.voter_count, stats.state_count, staged.warnings, staged.unread_cells)


def build_models(
    spark: SparkSession, database: str, as_of: datetime, buckets: int | None = None
) -> dict[str, DataFrame]:
    """Bring the dimension and the stage up to date and rebuild the marts.

    Both keyed tables are bucketed by their key, so that the next run joins them and counts
    their ids without moving them.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dim_name, stage_name = f"{database}.dim_voter", f"{database}.stage_voter_metrics"
    raw = spark.table(f"{database}.vote_records")
    dim = publish(
        spark, dim_upsert(current(spark, dim_name), raw, as_of.date()), dim_name,
        schemas.DIM_VOTER, NULLABLE_NAMES, "source_id", buckets,
    )
    stage = publish(
        spark, stage_upsert(current(spark, stage_name), dim, as_of), stage_name,
        schemas.STAGE_VOTER_METRICS, (), "voter_id", buckets,
    )
    tables = {"dim_voter": dim, "stage_voter_metrics": stage}
    # The stage's key has just been checked, so voters may be counted as rows. The cells are
    # kept for the marts made from them; blocks lost with an executor are computed again.
    voters = marts.Voters.of(stage, one_row_per_voter=True)
    voters.cells.persist()
    try:
        for name, mart in marts.all_marts(voters, as_of.date()).items():
            tables[name] = publish(spark, mart, f"{database}.{name}", schemas.CONTRACTS[name])
    finally:
        voters.cells.unpersist()
    return tables


def check_report(spark: SparkSession, database: str, names: list[str], as_of: datetime) -> DataFrame:
    """Every declared check of the tables, one row each."""
    report = None
    for name in names:
        checked = run_checks(spark.table(f"{database}.{name}"), checks.DECLARED[name](as_of.date()))
        checked = checked.withColumn("table_name", F.lit(name))
        report = checked if report is None else report.unionByName(checked)
    return report


def build_calendars(
    spark: SparkSession,
    out: str,
    as_of: datetime,
    results_path: str | None = None,
    civic_path: str | None = None,
) -> list[str]:
    """Write the raw results, the historic outcomes and the upcoming calendar as CSV seeds.

    Returns the seeds written; an input that is not given, or is empty, leaves its seed out.
    """
    written = []

    def save(df: DataFrame, contract: schemas.Contract) -> None:
        if csv_sink(df, f"{out}/{contract.name}"):
            written.append(contract.name)

    if results_path:
        results = scan_results_tsv(spark, results_path)
        stamp = as_of.strftime("%Y-%m-%d %H:%M:%S+00:00")
        save(results.drop("seq").withColumn("insertion_date", F.lit(stamp)), schemas.RAW_RESULTS)
        historic = calendars.finalize_calendar(calendars.historic_outcomes(results), as_of)
        save(historic, schemas.HISTORIC_OUTCOMES)
    civic = scan_civic_json(spark, civic_path) if civic_path else None
    upcoming = calendars.finalize_calendar(calendars.upcoming_calendar(spark, as_of.date(), civic), as_of)
    save(upcoming, schemas.UPCOMING_CALENDAR)
    return written


SEED_DATABASES = {
    "elections_historic_raw": "fact",
    "election_outcome_federal_historic": "fact",
    "election_calendar_upcoming": "dim",
}


def load_seeds(spark: SparkSession, folder: str, names: list[str], prefix: str = "") -> dict[str, DataFrame]:
    """Replace the seed tables by the seeds' rows."""
    return {
        name: load_seed(spark, f"{folder}/{name}", schemas.CONTRACTS[name], prefix + SEED_DATABASES[name])
        for name in names
    }
