"""The data checks each table is declared to pass."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..constants import (
    AGE_GROUPS,
    CYCLE_TYPES,
    GENDERS,
    LEANS,
    PARTIES,
    SEGMENTS,
    SOURCE_CIVIC,
    SOURCE_COMPUTED,
    SOURCE_RESULTS,
    TIERS,
)
from ..operators import quality as Q
from ..schemas import STAGE_VOTER_METRICS

# --- Fixed values: bounds and patterns -----------------------------------------------------------
EARLIEST = date(1900, 1, 1)
VOTER_ID = "^[A-Za-z0-9_-]+$"
STATE_CODE = "^[A-Z]{2}$"
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
LARGEST_SEGMENT = 1_000_000
ELECTION_KINDS = ("Presidential", "Midterm", "Primary", "Special", "Off-Year")
ELECTION_LEVELS = ("Federal", "State", "Local")
OFFICES = ("President", "Senate", "House", "Congress", "Governor", "General")
RESULT_PARTIES = ("DEMOCRAT", "REPUBLICAN", "LIBERTARIAN", "GREEN", "OTHER")


def _present(column: str):
    return F.col(column).isNotNull()


def _groups() -> list[Q.Check]:
    """Checks of the demographic columns every mart has."""
    return [
        *Q.not_null("state", "age_group", "gender", "party"),
        Q.length_equals("state", 2),
        Q.accepted_values("age_group", AGE_GROUPS),
        Q.accepted_values("gender", GENDERS),
        Q.accepted_values("party", PARTIES),
    ]


def _percentages(*columns: str) -> list[Q.Check]:
    return [Q.between(c, 0.0, 100.0) for c in columns]


def raw_voters(as_of: date) -> list[Q.Check]:
    return Q.not_null("source_id")


def dim_voter(as_of: date) -> list[Q.Check]:
    return [
        Q.at_least("last_voted_date", "registered_date", _present("last_voted_date")),
        *Q.not_null(
            "source_id", "first_name", "last_name", "age", "gender", "state", "party", "email",
            "registered_date", "inserted_date", "last_modified_date",
        ),
        *Q.unique("source_id"),
        Q.length_between("first_name", 1, 100),
        Q.length_between("last_name", 1, 100),
        Q.between("age", 18, 120),
        Q.accepted_values("gender", GENDERS),
        Q.length_equals("state", 2),
        Q.accepted_values("party", PARTIES),
        Q.matches("email", EMAIL),
        Q.between("registered_date", EARLIEST, as_of),
        Q.between("last_voted_date", EARLIEST, as_of, _present("last_voted_date")),
    ]


def stage_voter_metrics(as_of: date) -> list[Q.Check]:
    missed, cycle = "elections_since_last_vote", "last_vote_cycle_type"
    return [
        Q.ColumnsCheck(tuple(STAGE_VOTER_METRICS.columns)),
        *Q.not_null("voter_id"),
        *Q.unique("voter_id"),
        Q.matches("voter_id", VOTER_ID),
        *_groups(),
        Q.matches("state", STATE_CODE),
        *Q.not_null(
            "registered_date", "days_since_registered", "years_since_registered",
            "voter_engagement_segment", "last_processed_date",
        ),
        Q.between("registered_date", EARLIEST, as_of),
        Q.between("days_since_registered", 0, 50000),
        Q.between("years_since_registered", 0, 100),
        Q.between("last_voted_date", EARLIEST, as_of, _present("last_voted_date")),
        Q.accepted_values(missed, tuple(range(10))),
        Q.between(missed, 0, 20, _present(missed)),
        Q.accepted_values("voter_engagement_segment", SEGMENTS),
        Q.accepted_values(cycle, CYCLE_TYPES, _present(cycle)),
    ]


def voter_snapshot(as_of: date) -> list[Q.Check]:
    cycle = "last_vote_cycle_type"
    return [
        *_groups(),
        *Q.not_null("voter_engagement_segment", "total_voters", "snapshot_date"),
        Q.accepted_values("voter_engagement_segment", SEGMENTS),
        Q.accepted_values(cycle, CYCLE_TYPES, _present(cycle)),
        Q.between("total_voters", 1, LARGEST_SEGMENT),
        Q.between("avg_years_registered", 0.0, 100.0),
        Q.between("median_years_registered", 0.0, 100.0),
        Q.between("avg_elections_missed", 0.0, 20.0),
        *_percentages(
            "pct_current_voters", "pct_targetable_voters", "pct_high_opportunity_voters",
            "pct_missed_last_voters", "pct_occasional_voters", "pct_infrequent_voters",
            "pct_dormant_voters", "pct_never_voted",
        ),
    ]


def partisan_trends(as_of: date) -> list[Q.Check]:
    growth, points = "eligible_voter_change_pct", "participation_rate_change_pts"
    return [
        *Q.not_null("election_year", "election_type", "election_date"),
        Q.between("election_year", 2008, 2030),
        Q.accepted_values("election_type", ELECTION_KINDS[:2]),
        *_groups(),
        *Q.not_null("eligible_voters", "estimated_voters"),
        *_percentages("participation_rate", "pct_of_eligible_by_demo", "pct_of_voters_by_demo"),
        Q.between(growth, -100.0, 1000.0, _present(growth)),
        Q.between(points, -100.0, 100.0, _present(points)),
    ]


def targeting_opportunities(as_of: date) -> list[Q.Check]:
    return [
        *_groups(),
        *Q.not_null("targeting_tier", "state_rank", "national_rank", "total_voters", "analysis_date"),
        Q.accepted_values("targeting_tier", TIERS),
        Q.between("opportunity_score", 0.0, 100.0),
        Q.between("state_rank", 1, 1000),
        Q.between("national_rank", 1, 10000),
        Q.between("total_voters", 1, LARGEST_SEGMENT),
        *_percentages(
            "pct_prime_targets", "pct_broad_targets", "pct_active_voters", "pct_recently_lapsed",
            "pct_medium_lapsed", "pct_dormant", "pct_never_voted",
        ),
        Q.between("avg_elections_missed", 0.0, 20.0),
        Q.between("avg_registration_tenure", 0.0, 100.0),
    ]


def state_summary(as_of: date) -> list[Q.Check]:
    return [
        Q.RowCountCheck(1, 60),
        *Q.not_null("state", "total_registered_voters", "partisan_lean", "summary_date"),
        *Q.unique("state"),
        *_percentages(
            "pct_democrat", "pct_republican", "pct_independent", "pct_18_29", "pct_30_49",
            "pct_50_64", "pct_65_plus", "pct_female", "pct_male", "pct_current_voters",
            "pct_recoverable_voters", "pct_disengaged_voters", "pct_never_voted",
        ),
        Q.between("avg_elections_missed", 0.0, 20.0),
        Q.between("avg_years_registered", 0.0, 100.0),
        Q.between("median_years_registered", 0.0, 100.0),
        Q.between("engagement_opportunity_score", 0.0, 100.0),
        Q.accepted_values("partisan_lean", LEANS),
    ]


def raw_results(as_of: date) -> list[Q.Check]:
    return [
        *Q.not_null("year", "state", "state_po", "office", "candidatevotes", "totalvotes"),
        Q.accepted_values("party_simplified", RESULT_PARTIES),
    ]


def _calendar() -> list[Q.Check]:
    return [
        *Q.unique("election_id"),
        *Q.not_null("election_id", "election_date", "election_year", "election_name", "is_primary"),
        Q.accepted_values("election_type", ELECTION_KINDS),
        Q.accepted_values("office_type", OFFICES),
        *Q.not_null("data_source", "last_updated"),
    ]


def historic_outcomes(as_of: date) -> list[Q.Check]:
    return [
        *_calendar(),
        Q.accepted_values("election_level", ELECTION_LEVELS),
        Q.accepted_values("data_source", (SOURCE_RESULTS,)),
    ]


def upcoming_calendar(as_of: date) -> list[Q.Check]:
    return [
        *_calendar(),
        *Q.not_null("election_type", "election_level", "office_type"),
        Q.accepted_values("election_level", (*ELECTION_LEVELS, "General")),
        Q.accepted_values("data_source", (SOURCE_CIVIC, SOURCE_COMPUTED)),
        Q.unique_combination("election_date", "election_type", "election_level", "state"),
    ]


DECLARED = {
    "vote_records": raw_voters,
    "dim_voter": dim_voter,
    "stage_voter_metrics": stage_voter_metrics,
    "voter_snapshot": voter_snapshot,
    "partisan_trends": partisan_trends,
    "targeting_opportunities": targeting_opportunities,
    "state_summary": state_summary,
    "elections_historic_raw": raw_results,
    "election_outcome_federal_historic": historic_outcomes,
    "election_calendar_upcoming": upcoming_calendar,
}


def of_kind(checks: list[Q.Check], *names: str) -> list[Q.Check]:
    """The checks with one of the names."""
    return [c for c in checks if c.name in names]
