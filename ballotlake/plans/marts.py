"""The four summary tables.

All of them group voters by a few attributes with few values, so they are computed from
*cells*: voters counted per combination of those attributes. Building the cells is one
hash aggregation with partial sums, the only step that sees every voter; medians, ranks,
lags and the fan-out over election cycles then run on the cells alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (
    AGE_GROUPS,
    COMPETITIVE_GAPS,
    ELECTION_CYCLES,
    ENGAGEMENT_WEIGHTS,
    LEANS,
    MIN_SCORED_SEGMENT,
    OPPORTUNITY_WEIGHTS,
    PARTIES,
    SEGMENTS,
    TIER_RULES,
    TIERS,
    VOTE_WINDOW_DAYS,
)
from ..functions.numeric import percent, percent_or_zero, round_half_up
from ..functions.voters import likely_voted, was_registered
from ..operators.ranking import with_rank
from ..schemas import PARTISAN_TRENDS, STATE_SUMMARY, TARGETING_OPPORTUNITIES, VOTER_SNAPSHOT

DEMOGRAPHICS = ("state", "age_group", "gender", "party")
CELL_ATTRIBUTES = (
    *DEMOGRAPHICS,
    "voter_engagement_segment",
    "last_vote_cycle_type",
    "elections_since_last_vote",
    "years_since_registered",
)


# --- cells ---------------------------------------------------------------------------------------
def voter_cells(stage: DataFrame) -> DataFrame:
    """Rows (``n``) and rows with an id (``n_ids``) per combination of the attributes."""
    return stage.groupBy(*CELL_ATTRIBUTES).agg(
        F.count(F.lit(1)).alias("n"), F.count("voter_id").alias("n_ids")
    )


@dataclass(frozen=True)
class Voters:
    """Stage rows as the marts use them.

    ``one_row_per_voter`` says that no id occurs twice, as the stage's key promises; voters
    are then counted in the cells. Otherwise ids are counted by a distinct count of their own.
    """

    stage: DataFrame
    cells: DataFrame
    one_row_per_voter: bool = False

    @classmethod
    def of(cls, stage: DataFrame | Voters, one_row_per_voter: bool = False) -> Voters:
        if isinstance(stage, Voters):
            return stage
        return cls(stage, voter_cells(stage), one_row_per_voter)

    def summarize(self, keys: Sequence[str], total: str, **measures: Column) -> DataFrame:
        """Number of distinct voters per group as ``total``, and measures over the cells."""
        named = [column.alias(name) for name, column in measures.items()]
        if self.one_row_per_voter:
            return self.cells.groupBy(*keys).agg(F.sum("n_ids").alias(total), *named)
        counted = self.stage.groupBy(*keys).agg(F.count_distinct("voter_id").alias(total)).alias("c")
        measured = self.cells.groupBy(*keys).agg(*named).alias("m")
        same = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys])
        return counted.join(measured, same).select(
            *[F.col(f"c.{k}") for k in keys], total, *[F.col(f"m.{name}") for name in measures]
        )


def _voters_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))


def _mean(column: str) -> Column:
    """Mean over the voters that have the value; null if none has."""
    counted = F.sum(F.when(F.col(column).isNotNull(), F.col("n")))
    return F.sum(F.col(column) * F.col("n")).cast("double") / counted


def _median(column: str) -> Column:
    return F.percentile(column, F.lit(0.5), F.col("n"))


def _segment_in(*names: str) -> Column:
    return F.col("voter_engagement_segment").isin(*names)


# --- voter_snapshot ------------------------------------------------------------------------------
def voter_snapshot(stage: DataFrame | Voters, as_of: date, one_row_per_voter: bool = False) -> DataFrame:
    """Voters by demographics, engagement segment and type of the last vote."""
    missed = F.col("elections_since_last_vote")
    names = (
        "current_voters", "missed_last_voters", "occasional_voters", "infrequent_voters",
        "dormant_voters", "never_voted",
    )
    counts = {name: _voters_where(_segment_in(segment)) for name, segment in zip(names, SEGMENTS)}
    counts["targetable_voters"] = _voters_where(missed >= 2)
    counts["high_opportunity_voters"] = _voters_where(missed >= 4)
    grouped = Voters.of(stage, one_row_per_voter).summarize(
        (*DEMOGRAPHICS, "voter_engagement_segment", "last_vote_cycle_type"),
        "total_voters",
        avg_years_registered=_mean("years_since_registered"),
        median_years_registered=_median("years_since_registered"),
        avg_elections_missed=_mean("elections_since_last_vote"),
        **counts,
    )
    shares = {f"pct_{name}": percent(F.col(name), F.col("total_voters")) for name in counts}
    return (
        grouped.withColumns(shares)
        .withColumn("snapshot_date", F.lit(as_of).cast("date"))
        .select(*VOTER_SNAPSHOT.columns)
        .orderBy(*[F.asc_nulls_last(c) for c in ("state", "party", "age_group", "gender")])
    )


# --- targeting_opportunities ---------------------------------------------------------------------
def opportunity_score(
    total: Column, recent: Column, medium: Column, tenure: Column,
    weights: Sequence[float] = OPPORTUNITY_WEIGHTS, smallest: int = MIN_SCORED_SEGMENT,
) -> Column:
    """0–100: weighted shares of recent and medium lapsers, tenure up to 10 years, size up to 1,000."""
    size = total.cast("double")
    w_recent, w_medium, w_tenure, w_size = (F.lit(float(w)) for w in weights)
    full = F.lit(1.0)
    raw = (
        w_recent * recent / size
        + w_medium * medium / size
        + w_tenure * F.least(tenure / F.lit(10.0), full)
        + w_size * F.least(size / F.lit(1000.0), full)
    )
    return F.when(total < smallest, F.lit(0.0)).otherwise(round_half_up(raw, 2))


def targeting_tier(score: Column, total: Column, rules: Sequence[tuple] = TIER_RULES) -> Column:
    tiers = [F.when((score >= least) & (total >= voters), F.lit(tier)) for tier, least, voters in rules]
    return F.coalesce(*tiers, F.lit(TIERS[-1]))


def targeting_opportunities(
    stage: DataFrame | Voters,
    as_of: date,
    one_row_per_voter: bool = False,
    weights: Sequence[float] = OPPORTUNITY_WEIGHTS,
    min_scored_segment: int = MIN_SCORED_SEGMENT,
    tier_rules: Sequence[tuple] = TIER_RULES,
) -> DataFrame:
    """Demographic segments ranked by re-engagement score, nationally and within their state.

    Equal scores are ranked by size, then by state, age group, gender and party.
    """
    missed = F.col("elections_since_last_vote")
    total = F.col("total_voters")
    grouped = Voters.of(stage, one_row_per_voter).summarize(
        DEMOGRAPHICS,
        "total_voters",
        active_voters=_voters_where(missed == 0),
        lapsed_1_election=_voters_where(missed == 1),
        lapsed_2_3_elections=_voters_where(missed.between(2, 3)),
        lapsed_4_6_elections=_voters_where(missed.between(4, 6)),
        dormant_voters=_voters_where(missed >= 7),
        never_voted=_voters_where(missed.isNull()),
        prime_target_voters=_voters_where(missed.between(1, 3)),
        broad_target_voters=_voters_where(missed.between(2, 6)),
        avg_elections_missed=_mean("elections_since_last_vote"),
        avg_registration_tenure=_mean("years_since_registered"),
    )
    medium = F.col("lapsed_2_3_elections") + F.col("lapsed_4_6_elections")
    parts = {
        "pct_prime_targets": F.col("prime_target_voters"),
        "pct_broad_targets": F.col("broad_target_voters"),
        "pct_active_voters": F.col("active_voters"),
        "pct_recently_lapsed": F.col("lapsed_1_election"),
        "pct_medium_lapsed": medium,
        "pct_dormant": F.col("dormant_voters"),
        "pct_never_voted": F.col("never_voted"),
    }
    scored = grouped.withColumns({name: percent(part, total) for name, part in parts.items()}).withColumn(
        "opportunity_score",
        opportunity_score(
            total, F.col("lapsed_1_election"), medium, F.col("avg_registration_tenure"),
            weights, min_scored_segment,
        ),
    )
    order = [
        F.desc_nulls_last("opportunity_score"), F.desc_nulls_last("total_voters"),
        *[F.asc_nulls_last(c) for c in DEMOGRAPHICS],
    ]
    return (
        with_rank(scored, order, "national_rank")
        .withColumn("state_rank", F.row_number().over(Window.partitionBy("state").orderBy("national_rank")))
        .withColumn("targeting_tier", targeting_tier(F.col("opportunity_score"), total, tier_rules))
        .withColumn("analysis_date", F.lit(as_of).cast("date"))
        .where(total >= 1)
        .select(*TARGETING_OPPORTUNITIES.columns)
        .orderBy("national_rank")
    )


# --- state_summary -------------------------------------------------------------------------------
def partisan_lean(democrat: Column, republican: Column, gaps: Sequence[float] = COMPETITIVE_GAPS) -> Column:
    tight, close = gaps
    gap = F.abs(democrat - republican)
    highly, competitive, left, right = LEANS
    return (
        F.when(gap <= tight, highly)
        .when(gap <= close, competitive)
        .when(democrat > republican, left)
        .otherwise(right)
    )


def state_summary(stage: DataFrame | Voters, as_of: date, one_row_per_voter: bool = False) -> DataFrame:
    """One row per state: party, age, gender and engagement shares, scores and partisan lean."""
    current, missed_last, occasional, infrequent, dormant, never = SEGMENTS
    total = F.col("total_registered_voters")
    grouped = Voters.of(stage, one_row_per_voter).summarize(
        ("state",),
        "total_registered_voters",
        **{f"{p.lower()}_voters": _voters_where(F.col("party") == p) for p in PARTIES},
        **{f"age_{i}": _voters_where(F.col("age_group") == a) for i, a in enumerate(AGE_GROUPS)},
        female=_voters_where(F.col("gender") == "F"),
        male=_voters_where(F.col("gender") == "M"),
        current_voters=_voters_where(_segment_in(current)),
        recoverable_voters=_voters_where(_segment_in(missed_last, occasional)),
        disengaged_voters=_voters_where(_segment_in(infrequent, dormant)),
        never=_voters_where(_segment_in(never)),
        mean_missed=_mean("elections_since_last_vote"),
        mean_years=_mean("years_since_registered"),
        median_years=_median("years_since_registered"),
    )
    parts = {
        "pct_democrat": "democrat_voters",
        "pct_republican": "republican_voters",
        "pct_independent": "independent_voters",
        "pct_18_29": "age_0",
        "pct_30_49": "age_1",
        "pct_50_64": "age_2",
        "pct_65_plus": "age_3",
        "pct_female": "female",
        "pct_male": "male",
        "pct_current_voters": "current_voters",
        "pct_recoverable_voters": "recoverable_voters",
        "pct_disengaged_voters": "disengaged_voters",
        "pct_never_voted": "never",
    }
    shares = grouped.withColumns({name: percent(F.col(part), total) for name, part in parts.items()})
    w_recoverable, w_disengaged, w_never = (F.lit(w) for w in ENGAGEMENT_WEIGHTS)
    score = (
        F.col("pct_recoverable_voters") * w_recoverable
        + F.col("pct_disengaged_voters") * w_disengaged
        + F.col("pct_never_voted") * w_never
    )
    return (
        shares.withColumns(
            {
                "avg_elections_missed": round_half_up(F.col("mean_missed"), 2),
                "avg_years_registered": round_half_up(F.col("mean_years"), 1),
                "median_years_registered": round_half_up(F.col("median_years"), 1),
                "engagement_opportunity_score": round_half_up(score, 2),
                "partisan_lean": partisan_lean(F.col("pct_democrat"), F.col("pct_republican")),
                "summary_date": F.lit(as_of).cast("date"),
            }
        )
        .select(*STATE_SUMMARY.columns)
        .orderBy(F.desc("total_registered_voters"), F.asc_nulls_last("state"))
    )


# --- partisan_trends -----------------------------------------------------------------------------
def _cycle_array(cycles: Sequence[tuple]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(year).cast("int").alias("election_year"),
                F.lit(kind).alias("election_type"),
                F.lit(day).alias("election_date"),
            )
            for year, kind, day in cycles
        ]
    )


def voter_eligibility(
    stage: DataFrame, cycles: Sequence[tuple] = ELECTION_CYCLES, window: int = VOTE_WINDOW_DAYS
) -> DataFrame:
    """One row per voter and cycle: registered by then, and likely to have voted.

    The cycles are a literal array each row is expanded by, so this is a projection; no
    join and no shuffle.
    """
    columns = ("voter_id", *DEMOGRAPHICS, "registered_date")
    day = F.col("election_date")
    return (
        stage.select(*columns, "last_voted_date", F.inline(_cycle_array(cycles)))
        .withColumn("was_registered", was_registered(F.col("registered_date"), day).cast("int"))
        .withColumn(
            "likely_voted",
            likely_voted(F.col("registered_date"), F.col("last_voted_date"), day, window).cast("int"),
        )
        .select(
            *columns, "election_date", "election_type", "election_year", "was_registered", "likely_voted"
        )
    )


CYCLE_KEYS = ("election_year", "election_type", "election_date")
DEMO_KEYS = (*CYCLE_KEYS, "state", "age_group", "gender")
PARTY_KEYS = (*DEMO_KEYS, "party")


CYCLES_PER_WORD = 62


def cycle_counts(
    stage: DataFrame, cycles: Sequence[tuple] = ELECTION_CYCLES, window: int = VOTE_WINDOW_DAYS
) -> DataFrame:
    """Registered and likely voters per cycle and demographic group, one row per combination met.

    Each voter's answers for all cycles are packed into bit sets, a word for every 62 cycles, voters
    are counted per (group, bit sets), and only those few counted rows are expanded over the cycles.
    They are brought together by state, age group and gender, which serves all that follows.
    """
    registered, voted = F.col("registered_date"), F.col("last_voted_date")

    def words(name: str, answer) -> list[Column]:
        found = []
        for first in range(0, len(cycles), CYCLES_PER_WORD):
            flags = [
                F.when(answer(F.lit(day)), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                for i, (_, _, day) in enumerate(cycles[first:first + CYCLES_PER_WORD])
            ]
            found.append(reduce(lambda a, b: a + b, flags).alias(f"{name}_{len(found)}"))
        return found

    flagged = [
        *words("registered", lambda day: was_registered(registered, day)),
        *words("voted", lambda day: likely_voted(registered, voted, day, window)),
    ]
    packed = stage.select(*DEMOGRAPHICS, *flagged)
    names = packed.columns[len(DEMOGRAPHICS):]
    counted = packed.groupBy(*packed.columns).agg(F.count(F.lit(1)).alias("n"))

    def answers(name: str) -> Column:
        word = F.get(F.array(*[c for c in names if c.startswith(name)]), F.floor(F.col("bit") / CYCLES_PER_WORD).cast("int"))
        return F.col("n") * F.getbit(word, F.col("bit") % CYCLES_PER_WORD)

    return (
        counted.repartition("state", "age_group", "gender")
        .select(*DEMOGRAPHICS, "n", *names, F.posexplode(_cycle_array(cycles)).alias("bit", "cycle"))
        .select("cycle.*", *DEMOGRAPHICS, answers("registered").alias("registered"), answers("voted").alias("voted"))
        .groupBy(*PARTY_KEYS)
        .agg(F.sum("registered").alias("eligible_voters"), F.sum("voted").alias("estimated_voters"))
    )


def demo_totals(stage: DataFrame, cycles: Sequence[tuple] = ELECTION_CYCLES) -> DataFrame:
    """Registered and likely voters per cycle, state, age group and gender, all parties together."""
    return cycle_counts(stage, cycles).groupBy(*DEMO_KEYS).agg(
        F.sum("eligible_voters").alias("demo_eligible_total"),
        F.sum("estimated_voters").alias("demo_voted_total"),
    )


def party_totals(stage: DataFrame, cycles: Sequence[tuple] = ELECTION_CYCLES) -> DataFrame:
    """The same per party, for the groups that had a registered voter."""
    return cycle_counts(stage, cycles).where(F.col("eligible_voters") > 0)


def partisan_trends(
    stage: DataFrame | Voters, cycles: Sequence[tuple] = ELECTION_CYCLES, window: int = VOTE_WINDOW_DAYS
) -> DataFrame:
    """Party participation and shares per cycle, with the change since the last cycle of the same type."""
    rows = stage.stage if isinstance(stage, Voters) else stage
    demographic = Window.partitionBy(*DEMO_KEYS)
    previous = Window.partitionBy(*DEMOGRAPHICS, "election_type").orderBy("election_year")
    eligible, estimated = F.col("eligible_voters"), F.col("estimated_voters")
    before, rate_before = F.col("prev_eligible_voters"), F.col("prev_participation_rate")
    rate = F.col("participation_rate")
    return (
        cycle_counts(rows, cycles, window)
        # Groups without a registered voter add nothing to the demographic totals.
        .where(eligible > 0)
        .withColumn("participation_rate", percent_or_zero(estimated, eligible))
        .withColumn("pct_of_eligible_by_demo", percent_or_zero(eligible, F.sum(eligible).over(demographic)))
        .withColumn("pct_of_voters_by_demo", percent_or_zero(estimated, F.sum(estimated).over(demographic)))
        .withColumn("prev_eligible_voters", F.lag(eligible).over(previous))
        .withColumn("prev_participation_rate", F.lag(rate).over(previous))
        .withColumn("eligible_voter_change_pct", F.when(before > 0, percent(eligible - before, before)))
        .withColumn("participation_rate_change_pts", round_half_up(rate - rate_before, 2))
        .select(*PARTISAN_TRENDS.columns)
        .orderBy(
            F.desc("election_year"),
            *[F.asc_nulls_last(c) for c in ("state", "party", "age_group", "gender")],
        )
    )


MARTS = ("voter_snapshot", "partisan_trends", "targeting_opportunities", "state_summary")


def all_marts(
    stage: DataFrame | Voters, as_of: date, one_row_per_voter: bool = False
) -> dict[str, DataFrame]:
    """The four marts. Given :class:`Voters` whose cells are persisted, three of them share one pass."""
    voters = Voters.of(stage, one_row_per_voter)
    return {
        "voter_snapshot": voter_snapshot(voters, as_of),
        "partisan_trends": partisan_trends(voters),
        "targeting_opportunities": targeting_opportunities(voters, as_of),
        "state_summary": state_summary(voters, as_of),
    }
