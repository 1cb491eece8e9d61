"""The tables behind the dashboard's charts, and the documented example queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import GENDERS, LEANS, PARTIES, SEGMENTS, TIERS
from ..functions.numeric import mean_of_hundredths, percent, round_half_even

SHOWN_SEGMENTS = 10
LOADED_SEGMENTS = 20
GRID_STATES = 15
GRID_COLUMNS = 3
SNAPSHOT_KEYS = ("state", "age_group", "gender", "party", "voter_engagement_segment", "last_vote_cycle_type")


# --- table views ---------------------------------------------------------------------------------
def states_by_size(state_summary: DataFrame) -> DataFrame:
    return state_summary.orderBy(F.desc("total_registered_voters"), "state")


def segments_by_size(voter_snapshot: DataFrame) -> DataFrame:
    return voter_snapshot.orderBy(F.desc("total_voters"), *SNAPSHOT_KEYS)


def stage_by_registration(stage: DataFrame) -> DataFrame:
    # Many voters share a day, a default date say; the id keeps them from meeting in one task.
    return stage.orderBy(F.asc_nulls_last("registered_date"), "voter_id")


# --- headline figures and trends -----------------------------------------------------------------
def kpis(state_summary: DataFrame) -> DataFrame:
    """All registered voters, and the mean of the states' current-voter percentages."""
    return state_summary.agg(
        F.sum("total_registered_voters").alias("total_registered_voters"),
        mean_of_hundredths(F.col("pct_current_voters")).alias("avg_engagement_pct"),
    )


def engagement_trend(partisan_trends: DataFrame) -> DataFrame:
    """Mean participation per cycle and party over the groups that took part."""
    return (
        partisan_trends.where(F.col("participation_rate") > 0)
        .dropna(subset=["election_year", "party"])
        .groupBy("election_year", "party")
        .agg(mean_of_hundredths(F.col("participation_rate")).alias("avg_participation_rate"))
        .orderBy("election_year", "party")
    )


# --- outreach ------------------------------------------------------------------------------------
def loaded_targets(targeting: DataFrame, rows: int = LOADED_SEGMENTS) -> DataFrame:
    """The best segments of the two upper tiers."""
    return (
        targeting.where(F.col("targeting_tier").isin(*TIERS[:2]))
        .orderBy(F.desc("opportunity_score"), "national_rank")
        .limit(rows)
    )


def top_targets(targeting: DataFrame, shown: int = SHOWN_SEGMENTS) -> DataFrame:
    """The first of them with their score on the display scale."""
    score = F.col("opportunity_score")
    best = F.max(score).over(Window.partitionBy(F.lit(1)))
    shown_score = F.when(best > 100, round_half_even(score / best * 100.0, 1)).otherwise(
        round_half_even(score, 1) / F.lit(100.0)
    )
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("opportunity_score"), "national_rank"))
    return (
        loaded_targets(targeting)
        .select(
            place.alias("place"), "state", "age_group", "party",
            shown_score.alias("opportunity_score_display"),
        )
        .where(F.col("place") <= shown)
        .orderBy("place")
    )


def state_grid(state_summary: DataFrame, states: int = GRID_STATES, columns: int = GRID_COLUMNS) -> DataFrame:
    """The states with the highest engagement score, laid out row by row on a grid."""
    order = [F.desc("engagement_opportunity_score"), F.desc("total_registered_voters"), F.asc("state")]
    best = state_summary.orderBy(*order).limit(states)
    position = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)) - 1
    return (
        best.withColumn("position", position)
        .select(
            "state",
            F.floor(F.col("position") / columns).cast("int").alias("grid_row"),
            (F.col("position") % columns).cast("int").alias("grid_col"),
            round_half_even(F.col("engagement_opportunity_score"), 1).alias("engagement_opportunity_score"),
            round_half_even(F.col("pct_recoverable_voters"), 1).alias("pct_recoverable_voters"),
        )
        .withColumn(
            "label",
            F.format_string(
                "%s<br>%.1f%% rec<br>%.1f eng", "state", "pct_recoverable_voters", "engagement_opportunity_score"
            ),
        )
        .orderBy("grid_row", "grid_col")
    )


# --- demographics --------------------------------------------------------------------------------
def _wide(df: DataFrame, index: list[str], column: str, values: tuple[str, ...], measure: Column) -> DataFrame:
    """One row per index, one column per value, 0 where there is no voter; rows with a null key are left out."""
    return (
        df.dropna(subset=[*index, column])
        .groupBy(*index)
        .pivot(column, list(values))
        .agg(measure)
        .na.fill(0, subset=list(values))
    )


def _men_to_the_left(df: DataFrame) -> DataFrame:
    return df.withColumn("M", -F.col("M"))


def gender_engagement(voter_snapshot: DataFrame) -> DataFrame:
    """Voters by segment and party, women positive and men negative, in segment order."""
    place = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("voter_engagement_segment"))
    wide = _wide(
        voter_snapshot, ["voter_engagement_segment", "party"], "gender", GENDERS, F.sum("total_voters")
    )
    return (
        _men_to_the_left(wide)
        .withColumn("segment_order", (place - 1).cast("int"))
        .orderBy("segment_order", "party")
    )


def gender_party(voter_snapshot: DataFrame) -> DataFrame:
    """Voters by gender and party with the party's share of the gender."""
    total = F.sum("total_voters").over(Window.partitionBy("gender"))
    return (
        voter_snapshot.dropna(subset=["gender", "party"])
        .groupBy("gender", "party")
        .agg(F.sum("total_voters").alias("total_voters"))
        .withColumn("pct_of_gender", percent(F.col("total_voters"), total))
        .orderBy("gender", "party")
    )


def _with_year(stage: DataFrame) -> DataFrame:
    return stage.withColumn("registration_year", F.year("registered_date"))


def registrations_by_year(stage: DataFrame) -> DataFrame:
    return (
        _with_year(stage)
        .dropna(subset=["registration_year"])
        .groupBy("registration_year")
        .agg(F.count(F.lit(1)).alias("registered_voters"))
        .orderBy("registration_year")
    )


def gender_by_year(stage: DataFrame) -> DataFrame:
    """Registrations by year and party, women positive and men negative, newest year first."""
    wide = _wide(_with_year(stage), ["registration_year", "party"], "gender", GENDERS, F.count(F.lit(1)))
    return _men_to_the_left(wide).orderBy(F.desc("registration_year"), "party")


def age_by_party(stage: DataFrame) -> DataFrame:
    return _wide(stage, ["age_group"], "party", PARTIES, F.count(F.lit(1))).orderBy("age_group")


# --- documented example queries ------------------------------------------------------------------
def example_snapshot(voter_snapshot: DataFrame) -> DataFrame:
    return voter_snapshot.orderBy(F.desc("pct_targetable_voters"), *SNAPSHOT_KEYS).select(
        "state", "party", "pct_current_voters", "pct_targetable_voters"
    )


def example_trends(partisan_trends: DataFrame, party: str = "Democrat", state: str = "PA") -> DataFrame:
    return (
        partisan_trends.where((F.col("party") == party) & (F.col("state") == state))
        .select("election_year", "election_type", "state", "participation_rate")
        .orderBy(F.desc("election_year"))
    )


def example_targets(targeting: DataFrame, rows: int = 20) -> DataFrame:
    return (
        targeting.where(F.col("targeting_tier") == TIERS[0])
        .orderBy(F.desc("opportunity_score"), "national_rank")
        .limit(rows)
        .select("state", "age_group", "gender", "party", "opportunity_score", "prime_target_voters")
    )


def example_states(state_summary: DataFrame) -> DataFrame:
    return (
        state_summary.where(F.col("partisan_lean").isin(*LEANS[:2]))
        .select("state", "partisan_lean", "engagement_opportunity_score", "total_registered_voters")
        .orderBy(F.desc("engagement_opportunity_score"), "state")
    )
