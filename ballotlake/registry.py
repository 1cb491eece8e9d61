"""Every dataset and operator as a query over a folder of order tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .constants import VOTER_COLUMNS
from .functions import elections as E
from .functions import voters as V
from .functions.literals import latest_moment, timestamp_literal
from .operators import quality as Q
from .operators.dedup import unseen_records
from .operators.sinks import csv_sink
from .plans import calendars, checks, dashboards, ingest, marts, pipeline
from .plans import voters as people
from .session import shared_dir
from .sources import derived, election_files, voter_files
from .streaming.voter_stream import ingest_stream, read_raw

AS_OF = date(2025, 6, 30)
AS_OF_TIME = datetime(2025, 6, 30)
DAY_BEFORE = date(2025, 6, 29)
NOON_BEFORE = datetime(2025, 6, 29, 12)
NOON = datetime(2025, 6, 30, 12)
FALLBACK = datetime(2025, 1, 1)
# Order numbers that share a civic document; it bounds a document's listings.
LISTED_TOGETHER = 2048

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs -------------------------------------------------------------------------------
def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return derived.voters(spark, folder)


def _dim(spark: SparkSession, folder: str) -> DataFrame:
    return people.dim_voter(_raw(spark, folder), AS_OF)


def _stage(spark: SparkSession, folder: str) -> DataFrame:
    return people.stage_voter_metrics(_dim(spark, folder), AS_OF)


def _people(spark: SparkSession, folder: str) -> marts.Voters:
    """The stage as the marts take it; the dimension has one row per voter by construction."""
    return marts.Voters.of(_stage(spark, folder), one_row_per_voter=True)


def _earlier() -> Column:
    """Rows a first load had: no vote, or the last one before 2012."""
    return F.coalesce(F.col("last_voted_date") < F.lit(date(2012, 1, 1)), F.lit(True))


def _files(raw: DataFrame) -> DataFrame:
    """Raw rows as if they had come in files, one per five years of last votes."""
    number = F.coalesce(F.floor(F.year("last_voted_date") / 5).cast("int"), F.lit(0))
    return raw.withColumn("file_order", number).withColumn(
        "source_file", F.concat(F.lit("voters_"), number.cast("string"), F.lit(".csv"))
    )


def _write_csv(df: DataFrame, folder: str) -> None:
    df.write.mode("append").option("header", "true").option("escape", '"').csv(folder)


def _texts(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("source_id").alias("id"), *VOTER_COLUMNS[1:])


# --- voter models --------------------------------------------------------------------------------
@query
def dim_voter(spark: SparkSession, folder: str) -> DataFrame:
    return _dim(spark, folder)


@query
def stage_voter_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _stage(spark, folder)


@query
def voter_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return marts.voter_snapshot(_people(spark, folder), AS_OF)


@query
def partisan_trends(spark: SparkSession, folder: str) -> DataFrame:
    return marts.partisan_trends(_stage(spark, folder))


@query
def targeting_opportunities(spark: SparkSession, folder: str) -> DataFrame:
    return marts.targeting_opportunities(_people(spark, folder), AS_OF)


@query
def state_summary(spark: SparkSession, folder: str) -> DataFrame:
    return marts.state_summary(_people(spark, folder), AS_OF)


@query
def voter_snapshot_any_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Without the promise that a voter has one row: ids are counted distinctly."""
    return marts.voter_snapshot(_stage(spark, folder), AS_OF)


@query
def elections_since_last_vote(spark: SparkSession, folder: str) -> DataFrame:
    """Missed elections from the fixed days, and from a calendar table."""
    voters = calendars.elections_since(_dim(spark, folder), calendars.federal_calendar(spark, 2008, 2024))
    return voters.select(
        "source_id",
        "last_voted_date",
        V.elections_since_last_vote(F.col("last_voted_date")).alias("elections_since_last_vote"),
        "elections_in_calendar",
    )


@query
def voter_eligibility(spark: SparkSession, folder: str) -> DataFrame:
    return marts.voter_eligibility(_stage(spark, folder))


@query
def demo_totals(spark: SparkSession, folder: str) -> DataFrame:
    return marts.demo_totals(_stage(spark, folder))


@query
def party_totals(spark: SparkSession, folder: str) -> DataFrame:
    return marts.party_totals(_stage(spark, folder))


@query
def election_cycles(spark: SparkSession, folder: str) -> DataFrame:
    """The cycles with all registered and likely voters."""
    return marts.demo_totals(_stage(spark, folder)).groupBy(*marts.CYCLE_KEYS).agg(
        F.sum("demo_eligible_total").alias("registered_voters"),
        F.sum("demo_voted_total").alias("likely_voters"),
    )


# --- ingest --------------------------------------------------------------------------------------
@query
def record_hash(spark: SparkSession, folder: str) -> DataFrame:
    hashed = V.record_hash(*[F.col(c) for c in ingest.IDENTITY])
    return _raw(spark, folder).select("source_id", hashed.alias("record_hash"))


@query
def clean_voters(spark: SparkSession, folder: str) -> DataFrame:
    return voter_files.clean_voters(derived.voter_texts(spark, folder))


@query
def dedup_antijoin(spark: SparkSession, folder: str) -> DataFrame:
    records = ingest.raw_records(_raw(spark, folder), AS_OF_TIME)
    stored = records.where(F.col("registered_date") < F.lit(date(2005, 1, 1))).select("record_hash")
    return unseen_records(records, stored).select("source_id", "last_voted_date", "record_hash")


@query
def dedup_across_files(spark: SparkSession, folder: str) -> DataFrame:
    """Against stored rows and, file after file, against each other."""
    records = ingest.raw_records(_files(_raw(spark, folder)), AS_OF_TIME)
    stored = records.where(F.col("registered_date") < F.lit(date(2005, 1, 1))).select("record_hash")
    return unseen_records(records, stored, file_order="file_order").select(
        "source_id", "last_voted_date", "record_hash", "source_file"
    )


@query
def ingest_voters(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.ingest_voters(_files(_raw(spark, folder)), AS_OF_TIME).drop("record_uuid")


@query
def ingest_truncate(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.ingest_voters(_files(_raw(spark, folder)), AS_OF_TIME, truncate=True).drop("record_uuid")


@query
def ingest_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.ingest_metrics(_raw(spark, folder))


@query
def run_metadata(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder)
    first = ingest.run_metadata(None, ingest.ingest_metrics(raw.where(_earlier())), NOON_BEFORE, 1, 0)
    added = ingest.ingest_voters(_files(raw), AS_OF_TIME)
    # The next run's watermark, and the one of a first run that is given a fallback.
    watermark = ingest.last_watermark(first, FALLBACK)
    fallback = ingest.last_watermark(None, FALLBACK)
    return _metadata(raw, first, added).select(
        "*", timestamp_literal(watermark).alias("watermark"), timestamp_literal(fallback).alias("fallback")
    )


def _metadata(raw: DataFrame, first: DataFrame, added: DataFrame) -> DataFrame:
    return ingest.run_metadata(first, ingest.ingest_metrics(raw), NOON, 2, added)


@query
def dim_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A first load of the earlier rows, then a run over all rows on the next day."""
    raw = _raw(spark, folder)
    first = people.dim_upsert(None, raw.where(_earlier()), DAY_BEFORE)
    return people.dim_upsert(first, raw, AS_OF)


@query
def dim_upsert_same_day(spark: SparkSession, folder: str) -> DataFrame:
    """A second run on the same day adds nothing."""
    raw = _raw(spark, folder)
    first = people.dim_upsert(None, raw.where(_earlier()), AS_OF)
    return people.dim_upsert(first, raw, AS_OF)


@query
def stage_upsert(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder)
    first_dim = people.dim_upsert(None, raw.where(_earlier()), DAY_BEFORE)
    first = people.stage_upsert(None, first_dim, NOON_BEFORE)
    return people.stage_upsert(first, people.dim_upsert(first_dim, raw, AS_OF), NOON)


# --- files ---------------------------------------------------------------------------------------
@query
def scan_voter_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Voters written as CSV files, scanned back and cleaned. Line breaks inside quotes are in some files only."""
    files = shared_dir(spark, "voter-files")
    texts, breaks = derived.voter_texts(spark, folder), F.col("id").cast("bigint") % 43 < 9
    _write_csv(texts.where(breaks), files)
    _write_csv(texts.where(~breaks), files)
    return voter_files.clean_voters(voter_files.scan_voter_csv(spark, files)).select(*VOTER_COLUMNS)


@query
def scan_new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Only what was written after the watermark is read."""
    files = shared_dir(spark, "voter-files")
    texts = _texts(_raw(spark, folder))
    _write_csv(texts.where(_earlier()), files)
    watermark = latest_moment(voter_files.scan_new_files(spark, files), "modified_at")
    _write_csv(texts.where(~_earlier()), files)
    return voter_files.scan_voter_csv(spark, files, watermark).select(*VOTER_COLUMNS)


@query
def file_quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Good, wide, short, blank, empty and renamed files, each kind in a folder of its own."""
    base = shared_dir(spark, "gate-files")
    texts = _texts(_raw(spark, folder))
    nothing = [F.lit(None).cast("string").alias(c) for c in VOTER_COLUMNS]
    variants = {
        "good": texts,
        "wide": texts.select("*", *[F.lit("x").alias(f"more_{i}") for i in range(70)]),
        "short": texts.select("id", "first_name"),
        "blank": texts.select(*nothing),
        "headed": texts.where("false"),
        "renamed": texts.withColumnRenamed("email", "mail"),
    }
    paths = []
    for name, rows in variants.items():
        _write_csv(rows, f"{base}/{name}")
        paths += voter_files.new_file_paths(spark, f"{base}/{name}")
    gate = voter_files.file_quality_gate(spark, paths)
    return gate.groupBy(
        F.element_at(F.split("file_uri", "/"), -2).alias("variant"), "can_process", "error",
        "header_columns", "extra_columns", "missing_columns",
    ).agg(F.sum("total_rows").alias("total_rows"), F.sum("error_rows").alias("error_rows"))


@query
def schema_check(spark: SparkSession, folder: str) -> DataFrame:
    """Files without emails, without any gender and with a column too many."""
    files = shared_dir(spark, "schema-files")
    rows = _texts(_raw(spark, folder)).drop("email")
    rows = rows.withColumn("gender", F.lit(None).cast("string")).withColumn("ward", F.col("state"))
    _write_csv(rows, files)
    return voter_files.schema_check(voter_files.scan_as_headed(spark, voter_files.new_file_paths(spark, files)))


@query
def scan_results_tsv(spark: SparkSession, folder: str) -> DataFrame:
    """Results written as tab-separated text with quoted names, scanned back."""
    rows = derived.results(spark, folder)
    cells = {
        "year": F.col("year"),
        "state_po": F.concat(F.lit('"'), F.col("state_po"), F.lit('"')),
        "candidate": F.concat(F.lit('"""'), F.col("candidate"), F.lit('"""')),
        "candidatevotes": F.col("candidatevotes"),
        "totalvotes": F.col("totalvotes"),
        "notes": F.col("seq"),
        "party_simplified": F.col("party_simplified"),
    }
    lines = rows.select(
        *[cells.get(n, F.lit(None)).cast("string").alias(n) for n in schemas.RESULTS_FILE.fieldNames()]
    )
    path = shared_dir(spark, "results")
    plain = {"header": "true", "sep": "\t", "quote": "", "escapeQuotes": "false"}
    lines.write.options(**plain).csv(path)
    return election_files.scan_results_tsv(spark, path).drop("seq")


@query
def scan_civic_json(spark: SparkSession, folder: str) -> DataFrame:
    """Listings written as indented JSON documents of several elections, a file each, scanned back."""
    listed = derived.civic(spark, folder)
    one = F.struct("id", "name", "electionDay")
    path = shared_dir(spark, "civic")
    documents = listed.groupBy(F.floor(F.col("seq") / LISTED_TOGETHER)).agg(F.collect_list(one).alias("elections"))
    text = F.to_json(F.struct("elections"), {"pretty": "true"})
    documents.select(text).write.option("maxRecordsPerFile", 1).text(path)
    return election_files.scan_civic_json(spark, path).drop("seq")


def _historic(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.historic_outcomes(derived.results(spark, folder))


def _upcoming(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.upcoming_calendar(spark, AS_OF, derived.civic(spark, folder))


def _loaded_seeds(spark: SparkSession, folder: str) -> tuple[str, dict[str, DataFrame]]:
    """Both calendars written as CSV seeds and loaded into new databases."""
    path, prefix = shared_dir(spark, "seeds"), f"seed_{uuid.uuid4().hex[:8]}_"
    parts = {
        "election_outcome_federal_historic": _historic(spark, folder),
        "election_calendar_upcoming": _upcoming(spark, folder),
    }
    for name, part in parts.items():
        csv_sink(calendars.finalize_calendar(part, AS_OF_TIME), f"{path}/{name}")
    for database in ("fact", "dim"):
        spark.sql(f"CREATE DATABASE {prefix}{database} LOCATION '{path}/{database}.db'")
    return prefix, pipeline.load_seeds(spark, path, list(parts), prefix)


@query
def seed_load(spark: SparkSession, folder: str) -> DataFrame:
    """Both seeds as their tables have them."""
    _, tables = _loaded_seeds(spark, folder)
    rows = [table.drop("election_id").withColumn("seed", F.lit(name)) for name, table in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


@query
def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The seed tables the catalog lists, with their row counts."""
    prefix, tables = _loaded_seeds(spark, folder)
    counts = None
    for name, table in tables.items():
        count = table.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        counts = count if counts is None else counts.unionByName(count)
    listed = election_files.list_tables(spark, [f"{prefix}fact", f"{prefix}dim"])
    plain = F.replace("table_schema", F.lit(prefix), F.lit(""))
    return listed.withColumn("table_schema", plain).join(counts, "table_name").select(
        "table_schema", "table_name", "row_count"
    )


@query
def csv_sink_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The upcoming calendar written as CSV and read back as text."""
    path = shared_dir(spark, "calendar")
    csv_sink(_upcoming(spark, folder), path)
    text = ", ".join(f"{c} string" for c in calendars.DESCRIPTION)
    return spark.read.schema(text).option("header", "true").option("escape", '"').csv(path)


@query
def ingest_stream_voters(spark: SparkSession, folder: str) -> DataFrame:
    """Two waves of files through two runs of the stream, the second with its columns in another order."""
    base = shared_dir(spark, "stream")
    texts = _texts(_raw(spark, folder))
    turned = texts.select(*reversed(texts.columns))
    for wave in (texts.where(_earlier()), turned.where(~_earlier())):
        _write_csv(wave, f"{base}/files")
        ingest_stream(spark, f"{base}/files", f"{base}/raw", f"{base}/checkpoint", AS_OF_TIME)
    return read_raw(spark, f"{base}/raw").drop("record_uuid", "source_file", "batch_id", "key_part")


# --- elections -----------------------------------------------------------------------------------
@query
def election_day(spark: SparkSession, folder: str) -> DataFrame:
    """November and March election days of each voter's registration year."""
    year = F.year("registered_date")
    return _raw(spark, folder).select(
        "source_id",
        year.alias("registration_year"),
        E.election_day(year).alias("november"),
        E.election_day(year, 3).alias("march"),
    )


@query
def federal_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Federal elections of the even years in which someone registered."""
    year = F.year("registered_date")
    years = _raw(spark, folder).select((year - year % 2).alias("election_year")).distinct()
    return calendars.federal_elections(years).drop("seq")


@query
def classify_elections(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.classify_elections(derived.civic(spark, folder))


@query
def historic_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return _historic(spark, folder)


@query
def upcoming_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return _upcoming(spark, folder)


@query
def finalize_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.finalize_calendar(_historic(spark, folder), AS_OF_TIME).drop("election_id")


@query
def unified_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.unified_calendar(_historic(spark, folder), _upcoming(spark, folder))


@query
def calendar_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return calendars.calendar_by_source(_upcoming(spark, folder))


# --- checks --------------------------------------------------------------------------------------
def _published(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """Every table that has declared checks or a contract, as it is published."""
    raw = lambda: _raw(spark, folder)
    earlier = lambda: ingest.run_metadata(
        None, ingest.ingest_metrics(raw().where(_earlier())), NOON_BEFORE, 1, 0)
    stamp = AS_OF_TIME.strftime("%Y-%m-%d %H:%M:%S+00:00")
    return {
        "vote_records": lambda: ingest.ingest_voters(_files(raw()), AS_OF_TIME),
        "processing_metadata": lambda: _metadata(raw(), earlier(), ingest.ingest_voters(_files(raw()), AS_OF_TIME)),
        "dim_voter": lambda: _dim(spark, folder),
        "stage_voter_metrics": lambda: _stage(spark, folder),
        "voter_snapshot": lambda: voter_snapshot(spark, folder),
        "partisan_trends": lambda: partisan_trends(spark, folder),
        "targeting_opportunities": lambda: targeting_opportunities(spark, folder),
        "state_summary": lambda: state_summary(spark, folder),
        "elections_historic_raw": lambda: scan_results_tsv(spark, folder).withColumn("insertion_date", F.lit(stamp)),
        "election_outcome_federal_historic": lambda: calendars.finalize_calendar(_historic(spark, folder), AS_OF_TIME),
        "election_calendar_upcoming": lambda: calendars.finalize_calendar(_upcoming(spark, folder), AS_OF_TIME),
    }


def _united(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def _checked(spark: SparkSession, folder: str, *kinds: str) -> DataFrame:
    """The declared checks of some kinds on all tables that have any."""
    tables = _published(spark, folder)
    declared = {name: checks.of_kind(make(AS_OF), *kinds) for name, make in checks.DECLARED.items()}
    return _united([
        Q.run_checks(tables[name](), found).withColumn("table_name", F.lit(name))
        for name, found in declared.items() if found
    ])


@query
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "not_null")


@query
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "unique")


@query
def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "accepted_values")


@query
def dq_between(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "between")


@query
def dq_regex(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "matches_regex")


@query
def dq_length(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "length_equals", "length_between")


@query
def dq_pair_order(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "at_least")


@query
def dq_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "row_count_between")


@query
def dq_columns(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder, "columns_match")


@query
def dq_unique_combo(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar's key, on the calendar and on the listings it was made from."""
    listed = calendars.classify_elections(derived.civic(spark, folder))
    key = Q.unique_combination(*calendars.NATURAL_KEY)
    found = Q.run_checks(listed, [key]).withColumn("table_name", F.lit("civic_listings"))
    return _checked(spark, folder, "unique_combination").unionByName(found)


@query
def contract_check(spark: SparkSession, folder: str) -> DataFrame:
    """Every contract on its table."""
    return _united([
        Q.contract_report(table(), schemas.CONTRACTS[name]).withColumn("table_name", F.lit(name))
        for name, table in _published(spark, folder).items()
    ])


# --- dashboard -----------------------------------------------------------------------------------
def _dashboard(name: str, dataset: Callable[[DataFrame], DataFrame], source: Query) -> None:
    QUERIES[name] = lambda spark, folder: dataset(source(spark, folder))


_dashboard("dash_states", dashboards.states_by_size, state_summary)
_dashboard("dash_segments", dashboards.segments_by_size, voter_snapshot)
_dashboard("dash_stage", dashboards.stage_by_registration, _stage)
_dashboard("dash_kpis", dashboards.kpis, state_summary)
_dashboard("dash_engagement_trend", dashboards.engagement_trend, partisan_trends)
_dashboard("dash_top_targets", dashboards.top_targets, targeting_opportunities)
_dashboard("dash_state_grid", dashboards.state_grid, state_summary)
_dashboard("dash_gender_engagement", dashboards.gender_engagement, voter_snapshot)
_dashboard("dash_gender_party", dashboards.gender_party, voter_snapshot)
_dashboard("dash_reg_by_year", dashboards.registrations_by_year, _stage)
_dashboard("dash_gender_year", dashboards.gender_by_year, _stage)
_dashboard("dash_age_party", dashboards.age_by_party, _stage)
_dashboard("example_snapshot", dashboards.example_snapshot, voter_snapshot)
_dashboard("example_trends", dashboards.example_trends, partisan_trends)
_dashboard("example_targets", dashboards.example_targets, targeting_opportunities)
_dashboard("example_states", dashboards.example_states, state_summary)

# Names under which queries are known that would hide a function of this module.
QUERIES["csv_sink"] = QUERIES.pop("csv_sink_calendar")
QUERIES["ingest_stream"] = QUERIES.pop("ingest_stream_voters")
