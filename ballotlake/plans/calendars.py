"""Historic and upcoming election calendars."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    CALENDAR_END_YEAR,
    CALENDAR_LATEST_START,
    SOURCE_CIVIC,
    SOURCE_COMPUTED,
    SOURCE_RESULTS,
)
from ..functions import elections as E
from ..functions import voters as V
from ..operators.dedup import keep_first
from ..schemas import CALENDAR_COLUMNS

NATURAL_KEY = ("election_date", "election_type", "election_level", "state")
DESCRIPTION = (
    "election_date", "election_year", "election_name", "election_type", "election_level",
    "office_type", "is_primary", "state", "data_source",
)


def calendar_years(as_of: date) -> tuple[int, int]:
    """First and last year of the upcoming calendar."""
    latest_even = as_of.year - as_of.year % 2
    return min(CALENDAR_LATEST_START, latest_even), CALENDAR_END_YEAR


def federal_elections(years: DataFrame) -> DataFrame:
    """Federal elections of the given years (column ``election_year``).

    A general election per year and, in presidential years, a Super Tuesday primary;
    ``seq`` is the chronological listing order of the two within a year.
    """
    year = F.col("election_year")
    presidential = year % 4 == 0
    general = F.struct(
        F.lit(0).alias("seq"),
        E.election_day(year).alias("election_date"),
        F.concat(year.cast("string"), F.lit(" Federal General Election")).alias("election_name"),
        F.when(presidential, "Presidential").otherwise("Midterm").alias("election_type"),
        F.when(presidential, "President").otherwise("Congress").alias("office_type"),
        F.lit(False).alias("is_primary"),
        F.lit(None).cast("string").alias("state"),
    )
    primary = F.struct(
        F.lit(1).alias("seq"),
        E.election_day(year, 3).alias("election_date"),
        F.concat(year.cast("string"), F.lit(" Super Tuesday Presidential Primary")).alias("election_name"),
        F.lit("Primary").alias("election_type"),
        F.lit("President").alias("office_type"),
        F.lit(True).alias("is_primary"),
        F.lit("Multiple").alias("state"),
    )
    rows = F.when(presidential, F.array(general, primary)).otherwise(F.array(general))
    return (
        years.select(year.cast("int").alias("election_year"))
        .select("election_year", F.inline(rows))
        .withColumn("election_level", F.lit("Federal"))
        .withColumn("data_source", F.lit(SOURCE_COMPUTED))
        .select(*DESCRIPTION, (year.cast("bigint") * 2 + F.col("seq")).alias("seq"))
    )


def federal_calendar(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Federal elections of every second year from ``start`` to ``end``."""
    return federal_elections(spark.range(start, end + 1, 2).select(F.col("id").alias("election_year")))


def classify_elections(civic: DataFrame) -> DataFrame:
    """Civic listings (id, name, electionDay, seq) with year, type, level, office and state."""
    name, year = F.col("election_name"), F.col("election_year")
    return (
        civic.select(
            "seq",
            F.col("name").alias("election_name"),
            F.to_date(F.replace("electionDay", F.lit("T00:00:00Z"), F.lit(""))).alias("election_date"),
        )
        .withColumn("election_year", F.year("election_date"))
        .withColumn("election_type", E.election_type(name, year))
        .withColumn("election_level", E.election_level(name))
        .withColumn("office_type", E.office_type(name))
        .withColumn("is_primary", E.is_primary(name))
        .withColumn("state", E.state_token(name))
        .withColumn("data_source", F.lit(SOURCE_CIVIC))
        .select(*DESCRIPTION, "seq")
    )


def historic_outcomes(results: DataFrame) -> DataFrame:
    """One presidential election per year: votes cast and the row with the most votes.

    The first such row in ``seq`` order names the winner; its party is ``party_simplified``
    or, without that column, ``party_detailed``.
    """
    party = next((c for c in ("party_simplified", "party_detailed") if c in results.columns), None)
    has_winner = {"candidate", "candidatevotes"} <= set(results.columns)
    nothing = F.lit(None)

    def outcome(column: str | None, kind: str) -> Column:
        return (F.col(f"`{column}`") if column in results.columns else nothing).cast(kind)

    total = F.sum("totalvotes") if "totalvotes" in results.columns else nothing
    measures = [total.cast("bigint").alias("total_votes_cast")]
    if has_winner:
        row = F.struct(
            outcome("candidate", "string").alias("winner_name"),
            outcome(party, "string").alias("winner_party"),
            outcome("candidatevotes", "bigint").alias("winner_votes"),
        )
        # Most votes first, then the earliest row: the least of (-votes, place) where there are votes.
        votes = -F.col("candidatevotes").cast("bigint")
        place = F.when(votes.isNotNull(), F.struct(votes.alias("votes"), F.col("seq").alias("at")))
        measures.append(F.min_by(row, place).alias("winner"))
    grouped = results.groupBy(F.col("year").alias("election_year")).agg(*measures)
    winner = (
        ["winner.winner_name", "winner.winner_party", "winner.winner_votes"]
        if has_winner
        else [nothing.cast("string").alias("winner_name"), nothing.cast("string").alias("winner_party"),
              nothing.cast("bigint").alias("winner_votes")]
    )
    year = F.col("election_year")
    return (
        grouped.select("election_year", "total_votes_cast", *winner)
        .withColumn("election_date", E.election_day(year))
        .withColumn("election_name", F.concat(year.cast("string"), F.lit(" Presidential Election")))
        .withColumn("election_type", F.lit("Presidential"))
        .withColumn("election_level", F.lit("Federal"))
        .withColumn("office_type", F.lit("President"))
        .withColumn("is_primary", F.lit(False))
        .withColumn("state", nothing.cast("string"))
        .withColumn("data_source", F.lit(SOURCE_RESULTS))
        .select(*DESCRIPTION, "total_votes_cast", "winner_name", "winner_party", "winner_votes")
        .orderBy("election_date")
    )


def upcoming_calendar(spark: SparkSession, as_of: date, civic: DataFrame | None = None) -> DataFrame:
    """Civic listings and the computed federal schedule, one row per (date, type, level, state).

    A civic listing wins over a computed row, an earlier listing over a later one.
    """
    # The schedule has one row per key, so only listings can repeat among themselves.
    rows = federal_calendar(spark, *calendar_years(as_of)).drop("seq")
    if civic is not None:
        listed = classify_elections(civic)
        place = listed.schema["seq"].dataType
        rows = keep_first(
            listed.withColumn("_priority", F.lit(0)).unionByName(
                rows.withColumns({"_priority": F.lit(1), "seq": F.lit(None).cast(place)})),
            NATURAL_KEY, ["_priority", "seq"],
        )
    return rows.select(*DESCRIPTION).orderBy("election_date", *NATURAL_KEY[1:])


def finalize_calendar(df: DataFrame, as_of: datetime) -> DataFrame:
    """Add id and update time; bring the columns the dataset has to the calendar's order and types."""
    moment = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    stamp = moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S+00:00")
    full = (
        df.withColumn("election_id", F.expr("uuid()"))
        .withColumn("last_updated", F.lit(stamp))
        .withColumn("election_date", F.date_format("election_date", "yyyy-MM-dd"))
    )
    return full.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in CALENDAR_COLUMNS if f.name in full.columns]
    )


def unified_calendar(historic: DataFrame, upcoming: DataFrame) -> DataFrame:
    """Historic and upcoming elections on the columns both have."""
    shared = [c for c in historic.columns if c in upcoming.columns]
    return historic.select(*shared).unionByName(upcoming.select(*shared))


def calendar_by_source(calendar: DataFrame) -> DataFrame:
    """Elections per data source with first and last date, most frequent source first."""
    return (
        calendar.groupBy("data_source")
        .agg(
            F.count(F.lit(1)).alias("elections"),
            F.min("election_date").alias("first_date"),
            F.max("election_date").alias("last_date"),
        )
        .orderBy(F.desc("elections"), "data_source")
    )


def elections_since(
    voters: DataFrame, calendar: DataFrame, name: str = "elections_in_calendar"
) -> DataFrame:
    """Voters with the number of the calendar's federal general elections after their last vote.

    The election days reach every row as one sorted array. There is one such day every
    second year, so the array stays small whatever the calendar.
    """
    general = (F.col("election_level") == "Federal") & ~F.col("is_primary")
    days = calendar.where(general).agg(
        F.sort_array(F.collect_set(F.col("election_date").cast("date"))).alias("days")
    )
    return (
        voters.withColumn("_days", days.scalar())
        .withColumn(name, V.elections_since(F.col("last_voted_date"), F.col("_days")))
        .drop("_days")
    )
