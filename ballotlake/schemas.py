"""Column lists and types of every table, and which columns may not be null or repeat."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .constants import VOTER_COLUMNS


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """One "name type" per line."""
    columns = [line.split() for line in text.strip().splitlines()]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns])


@dataclass(frozen=True)
class Contract:
    """What a published table promises: ordered columns with types, required and unique columns."""

    name: str
    schema: T.StructType
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


VOTER_FILE = T.StructType([T.StructField(name, T.StringType()) for name in VOTER_COLUMNS])

RAW_VOTERS = Contract(
    "vote_records",
    _struct(
        """
        record_uuid string
        source_id string
        first_name string
        last_name string
        age int
        gender string
        state string
        party string
        email string
        registered_date date
        last_voted_date date
        source_file string
        record_hash string
        inserted_at timestamp
        updated_at timestamp
        """
    ),
    required=("record_uuid",),
    unique=("record_uuid",),
)

RUN_METADATA = Contract(
    "processing_metadata",
    _struct(
        """
        id int
        last_processed_at timestamp
        files_processed int
        records_processed int
        voter_count int
        state_count int
        created_at timestamp
        updated_at timestamp
        """
    ),
    required=("id",),
    unique=("id",),
)

DIM_VOTER = Contract(
    "dim_voter",
    _struct(
        """
        source_id string
        first_name string
        last_name string
        age int
        gender string
        state string
        party string
        email string
        registered_date date
        last_voted_date date
        inserted_date date
        last_modified_date date
        """
    ),
    required=(
        "source_id", "first_name", "last_name", "age", "gender", "state", "party", "email",
        "registered_date", "inserted_date", "last_modified_date",
    ),
    unique=("source_id",),
)

STAGE_VOTER_METRICS = Contract(
    "stage_voter_metrics",
    _struct(
        """
        voter_id string
        age_group string
        gender string
        state string
        party string
        registered_date date
        days_since_registered int
        years_since_registered int
        last_voted_date date
        elections_since_last_vote int
        voter_engagement_segment string
        last_vote_cycle_type string
        last_processed_date timestamp
        """
    ),
    required=(
        "voter_id", "age_group", "gender", "state", "party", "registered_date",
        "days_since_registered", "years_since_registered", "voter_engagement_segment",
        "last_processed_date",
    ),
    unique=("voter_id",),
)

VOTER_SNAPSHOT = Contract(
    "voter_snapshot",
    _struct(
        """
        state string
        age_group string
        gender string
        party string
        voter_engagement_segment string
        last_vote_cycle_type string
        total_voters bigint
        avg_years_registered double
        median_years_registered double
        avg_elections_missed double
        current_voters bigint
        missed_last_voters bigint
        occasional_voters bigint
        infrequent_voters bigint
        dormant_voters bigint
        never_voted bigint
        targetable_voters bigint
        high_opportunity_voters bigint
        pct_current_voters double
        pct_targetable_voters double
        pct_high_opportunity_voters double
        pct_missed_last_voters double
        pct_occasional_voters double
        pct_infrequent_voters double
        pct_dormant_voters double
        pct_never_voted double
        snapshot_date date
        """
    ),
    required=(
        "state", "age_group", "gender", "party", "voter_engagement_segment", "total_voters",
        "current_voters", "missed_last_voters", "occasional_voters", "infrequent_voters",
        "dormant_voters", "never_voted", "targetable_voters", "high_opportunity_voters",
        "snapshot_date",
    ),
)

PARTISAN_TRENDS = Contract(
    "partisan_trends",
    _struct(
        """
        election_year int
        election_type string
        election_date date
        state string
        age_group string
        gender string
        party string
        eligible_voters bigint
        estimated_voters bigint
        participation_rate double
        pct_of_eligible_by_demo double
        pct_of_voters_by_demo double
        prev_eligible_voters bigint
        prev_participation_rate double
        eligible_voter_change_pct double
        participation_rate_change_pts double
        """
    ),
    required=(
        "election_year", "election_type", "election_date", "state", "age_group", "gender",
        "party", "eligible_voters", "estimated_voters",
    ),
)

TARGETING_OPPORTUNITIES = Contract(
    "targeting_opportunities",
    _struct(
        """
        state string
        age_group string
        gender string
        party string
        targeting_tier string
        opportunity_score double
        state_rank int
        national_rank int
        total_voters bigint
        prime_target_voters bigint
        broad_target_voters bigint
        active_voters bigint
        lapsed_1_election bigint
        lapsed_2_3_elections bigint
        lapsed_4_6_elections bigint
        dormant_voters bigint
        never_voted bigint
        pct_prime_targets double
        pct_broad_targets double
        pct_active_voters double
        pct_recently_lapsed double
        pct_medium_lapsed double
        pct_dormant double
        pct_never_voted double
        avg_elections_missed double
        avg_registration_tenure double
        analysis_date date
        """
    ),
    required=(
        "state", "age_group", "gender", "party", "targeting_tier", "state_rank", "national_rank",
        "total_voters", "prime_target_voters", "broad_target_voters", "active_voters",
        "lapsed_1_election", "lapsed_2_3_elections", "lapsed_4_6_elections", "dormant_voters",
        "never_voted", "analysis_date",
    ),
)

STATE_SUMMARY = Contract(
    "state_summary",
    _struct(
        """
        state string
        total_registered_voters bigint
        pct_democrat double
        pct_republican double
        pct_independent double
        pct_18_29 double
        pct_30_49 double
        pct_50_64 double
        pct_65_plus double
        pct_female double
        pct_male double
        pct_current_voters double
        pct_recoverable_voters double
        pct_disengaged_voters double
        pct_never_voted double
        avg_elections_missed double
        avg_years_registered double
        median_years_registered double
        democrat_voters bigint
        republican_voters bigint
        independent_voters bigint
        current_voters bigint
        recoverable_voters bigint
        disengaged_voters bigint
        engagement_opportunity_score double
        partisan_lean string
        summary_date date
        """
    ),
    required=(
        "state", "total_registered_voters", "democrat_voters", "republican_voters",
        "independent_voters", "current_voters", "recoverable_voters", "disengaged_voters",
        "partisan_lean", "summary_date",
    ),
    unique=("state",),
)

# --- election tables -----------------------------------------------------------------------------
RESULTS_FILE = _struct(
    """
    year int
    state string
    state_po string
    state_fips int
    state_cen int
    state_ic int
    office string
    candidate string
    party_detailed string
    writein string
    candidatevotes int
    totalvotes int
    version string
    notes string
    party_simplified string
    """
)

RAW_RESULTS = Contract(
    "elections_historic_raw",
    T.StructType([*RESULTS_FILE.fields, T.StructField("insertion_date", T.TimestampType())]),
    required=("year", "state", "state_po", "office", "candidatevotes", "totalvotes"),
)

CIVIC_LISTING = _struct(
    """
    id string
    name string
    electionDay string
    """
)
CIVIC_FILE = T.StructType([T.StructField("elections", T.ArrayType(CIVIC_LISTING))])

# Types the calendar datasets are brought to, in order; a dataset keeps the columns it has.
CALENDAR_COLUMNS = _struct(
    """
    election_id string
    election_date string
    election_year bigint
    election_name string
    election_type string
    election_level string
    office_type string
    is_primary boolean
    state string
    total_votes_cast bigint
    winner_name string
    winner_party string
    winner_votes bigint
    data_source string
    last_updated string
    """
)

_CALENDAR_SEED = {
    "election_date": "date",
    "election_year": "int",
    "total_votes_cast": "bigint",
    "winner_votes": "int",
    "last_updated": "timestamp",
}
_HISTORIC_ONLY = ("total_votes_cast", "winner_name", "winner_party", "winner_votes")


def _seed_schema(skip: tuple[str, ...] = ()) -> T.StructType:
    columns = [f for f in CALENDAR_COLUMNS if f.name not in skip]
    return _struct(
        "\n".join(f"{f.name} {_CALENDAR_SEED.get(f.name, f.dataType.simpleString())}" for f in columns)
    )


HISTORIC_OUTCOMES = Contract(
    "election_outcome_federal_historic",
    _seed_schema(),
    required=(
        "election_id", "election_date", "election_year", "election_name", "is_primary",
        "data_source", "last_updated",
    ),
    unique=("election_id",),
)

UPCOMING_CALENDAR = Contract(
    "election_calendar_upcoming",
    _seed_schema(_HISTORIC_ONLY),
    required=(
        "election_id", "election_date", "election_year", "election_name", "election_type",
        "election_level", "office_type", "is_primary", "data_source", "last_updated",
    ),
    unique=("election_id",),
)

CONTRACTS = {
    c.name: c
    for c in (
        RAW_VOTERS, RUN_METADATA, DIM_VOTER, STAGE_VOTER_METRICS, VOTER_SNAPSHOT, PARTISAN_TRENDS,
        TARGETING_OPPORTUNITIES, STATE_SUMMARY, RAW_RESULTS, HISTORIC_OUTCOMES, UPCOMING_CALENDAR,
    )
}
