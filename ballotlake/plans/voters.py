"""The voter dimension and the per-voter engagement table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PARTIES
from ..functions import voters as V
from ..functions.literals import timestamp_literal
from ..operators.dedup import single_version
from ..operators.upsert import upsert
from ..schemas import DIM_VOTER, STAGE_VOTER_METRICS


def dim_voter(raw: DataFrame, as_of: date) -> DataFrame:
    """One cleaned row per voter id; ids with conflicting versions or missing facts are left out."""
    facts = raw.select(
        "source_id", "first_name", "last_name", "age", "gender", "state", "party",
        V.normalize_email(F.col("email")).alias("email"),
        "registered_date", "last_voted_date",
    )
    # The fact filters come after the version test: an invalid version still is a conflict.
    return (
        single_version(facts, "source_id")
        .dropna(subset=["age", "gender", "email", "registered_date"])
        .where((F.length("state") == 2) & F.col("party").isin(*PARTIES))
        .withColumns(
            {
                "inserted_date": F.lit(as_of).cast("date"),
                "last_modified_date": F.lit(as_of).cast("date"),
            }
        )
        .select(*DIM_VOTER.columns)
    )


def dim_updates(target: DataFrame | None, raw: DataFrame, as_of: date) -> DataFrame:
    """The dimension rows newer than anything in the target."""
    rows = dim_voter(raw, as_of)
    if target is None:
        return rows
    newest = target.agg(F.max("last_modified_date").alias("newest")).scalar()
    return rows.where(F.col("last_modified_date") > F.coalesce(newest, F.lit(date(1900, 1, 1))))


def dim_upsert(target: DataFrame | None, raw: DataFrame, as_of: date) -> DataFrame:
    """The dimension after a run. A second run on one day changes nothing; a voter that has
    become invalid keeps its old row."""
    return upsert(target, dim_updates(target, raw, as_of), "source_id")


def stage_voter_metrics(dim: DataFrame, as_of: date, processed_at: datetime | None = None) -> DataFrame:
    """Adult voters with tenure, missed elections, engagement segment and cycle type."""
    today = F.lit(as_of).cast("date")
    stamp = processed_at or datetime(as_of.year, as_of.month, as_of.day)
    registered, voted = F.col("registered_date"), F.col("last_voted_date")
    return (
        dim.where(F.col("age") >= 18)
        .withColumn("elections_since_last_vote", V.elections_since_last_vote(voted))
        .select(
            F.col("source_id").alias("voter_id"),
            V.age_group(F.col("age")).alias("age_group"),
            "gender",
            "state",
            "party",
            "registered_date",
            V.days_between(registered, today).alias("days_since_registered"),
            V.calendar_years_between(registered, today).alias("years_since_registered"),
            "last_voted_date",
            "elections_since_last_vote",
            V.engagement_segment(F.col("elections_since_last_vote")).alias("voter_engagement_segment"),
            V.vote_cycle_type(voted).alias("last_vote_cycle_type"),
            timestamp_literal(stamp).alias("last_processed_date"),
        )
        .select(*STAGE_VOTER_METRICS.columns)
    )


def stage_updates(
    target: DataFrame | None, dim: DataFrame, processed_at: datetime, process_when_empty: bool = False
) -> DataFrame:
    """Stage rows of the voters whose dimension row is younger than the last run.

    The dimension's dates count as midnight, so rows of the same day as the last run do not
    qualify, and with an existing but empty target none do. ``process_when_empty`` lifts the
    latter.
    """
    if target is not None:
        newest: Column = target.agg(F.max("last_processed_date").alias("newest")).scalar()
        if process_when_empty:
            newest = F.coalesce(newest, timestamp_literal(datetime(1900, 1, 1)))
        youngest = F.greatest("inserted_date", "last_modified_date").cast("timestamp")
        dim = dim.where(youngest > newest)
    return stage_voter_metrics(dim, processed_at.date(), processed_at)


def stage_upsert(
    target: DataFrame | None, dim: DataFrame, processed_at: datetime, process_when_empty: bool = False
) -> DataFrame:
    """The stage table after a run."""
    return upsert(target, stage_updates(target, dim, processed_at, process_when_empty), "voter_id")
