"""Whole runs: pipeline, stream, seeds."""

import json
import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ballotlake import schemas
from ballotlake.operators.quality import ContractError
from ballotlake.operators.sinks import current, publish
from ballotlake.plans import marts, pipeline
from ballotlake.sources.voter_files import RejectedFiles
from ballotlake.streaming.voter_stream import ingest_stream, read_raw
from samples import EXPECTED, VOTERS
from test_ingest import write

DAY1, DAY2 = datetime(2025, 6, 30, 9), datetime(2025, 7, 1, 9)


def lines(rows):
    return [",".join("" if v is None else str(v) for v in row) for row in rows]


@pytest.fixture
def database(spark):
    name = f"run_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_files_to_marts_and_back_again(spark, tmp_path, database):
    now = datetime.now()
    write(tmp_path, "one.csv", *lines(VOTERS[:6]), mtime=now.timestamp() - 7200)
    write(tmp_path, "two.csv", *lines(VOTERS[5:]), mtime=now.timestamp() - 3600)
    run = pipeline.load_voters(spark, str(tmp_path), database, now)
    assert run == pipeline.Run(2, 10, 10, 10)
    tables = pipeline.build_models(spark, database, DAY1, buckets=4)
    assert set(tables) == {"dim_voter", "stage_voter_metrics", *marts.MARTS}
    stage = spark.table(f"{database}.stage_voter_metrics")
    assert {r.voter_id: r.voter_engagement_segment for r in stage.collect()} == {k: v[3] for k, v in EXPECTED.items()}
    for name, table in tables.items():
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schemas.CONTRACTS[name].schema]
    report = pipeline.check_report(spark, database, list(tables), DAY1)
    assert report.where("NOT passed").collect() == []

    # Nothing new: the raw table stays, and so does everything made from it.
    assert pipeline.load_voters(spark, str(tmp_path), database, now).new_records == 0
    pipeline.build_models(spark, database, DAY1, buckets=4)
    assert spark.table(f"{database}.dim_voter").count() == 10

    # A new file on the next day: one known person with a later vote (left out) and one new voter.
    known = (*VOTERS[0][:9], date(2024, 11, 5))
    later = now.timestamp() + 3600
    write(tmp_path, "three.csv", *lines([known, ("11", *VOTERS[1][1:])]), mtime=later)
    run = pipeline.load_voters(spark, str(tmp_path), database, datetime.fromtimestamp(later))
    assert (run.files, run.new_records, run.voter_count) == (1, 1, 11)
    pipeline.build_models(spark, database, DAY2, buckets=4)
    dim = {r.source_id: r for r in spark.table(f"{database}.dim_voter").collect()}
    assert len(dim) == 11 and dim["1"].last_voted_date is None
    assert dim["1"].last_modified_date == DAY2.date()
    assert spark.table(f"{database}.state_summary").agg(F.sum("total_registered_voters")).first()[0] == 11


def test_the_fallback_watermark_and_what_a_run_reports(spark, tmp_path, database):
    now = datetime.now()
    write(tmp_path, "old.csv", *lines(VOTERS[:3]), mtime=now.timestamp() - 7200)
    odd = ("12", "Odd", None, "x", None, "VT", "Democrat", "o@mail.test", "2020/01/02", "2020-02-30")
    write(tmp_path, "new.csv", *lines([odd]), mtime=now.timestamp() - 1800)
    since = datetime.fromtimestamp(now.timestamp() - 3600)
    run = pipeline.load_voters(spark, str(tmp_path), database, now, fallback=since)
    assert run == pipeline.Run(1, 1, 1, 1)
    assert run.warnings == ("last_name: empty", "gender: empty") and run.unread_cells == 3
    later = datetime.fromtimestamp(now.timestamp() + 60)
    assert pipeline.load_voters(spark, str(tmp_path), database, later, fallback=since).files == 0


def test_stored_records_are_not_moved_by_a_new_load(spark, tmp_path, database):
    from ballotlake.operators.dedup import unseen_records

    now = datetime.now()
    write(tmp_path, "one.csv", *lines(VOTERS), mtime=now.timestamp() - 3600)
    pipeline.load_voters(spark, str(tmp_path), database, now)
    stored = spark.table(f"{database}.vote_records")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = [(r.record_hash,) for r in stored.limit(3).collect()]
        fresh = unseen_records(spark.createDataFrame(known, "record_hash string"), stored)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert fresh.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [k for k, line in enumerate(plan.split("\n")) if "Bucketed: true" in line]
    above = plan.split("\n")[scans[0] - 4:scans[0]]
    assert len(scans) == 1 and not any("Exchange" in line for line in above), "\n".join(above)


def test_broken_civic_documents_fail_and_indented_ones_are_read(spark, tmp_path):
    from ballotlake.sources.election_files import scan_civic_json

    listed = {"elections": [{"id": str(k), "name": "Runoff", "electionDay": "2025-07-04"} for k in range(2)]}
    (tmp_path / "good.json").write_text(json.dumps(listed, indent=2))
    assert [r.id for r in scan_civic_json(spark, str(tmp_path / "good.json")).collect()] == ["0", "1"]
    (tmp_path / "lines.json").write_text(json.dumps(listed) + "\n" + json.dumps(listed) + "\n")
    assert scan_civic_json(spark, str(tmp_path / "lines.json"), one_per_line=True).count() == 4
    (tmp_path / "bad.json").write_text('{"elections": [{"id": ')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        scan_civic_json(spark, str(tmp_path / "bad.json")).collect()


def test_truncate_replaces_the_table_by_the_new_files(spark, tmp_path, database):
    now = datetime.now()
    write(tmp_path, "one.csv", *lines(VOTERS), mtime=now.timestamp() - 3600)
    pipeline.load_voters(spark, str(tmp_path), database, now)
    write(tmp_path, "two.csv", *lines(VOTERS[:2] * 2), mtime=now.timestamp() + 3600)
    run = pipeline.load_voters(spark, str(tmp_path), database, now, truncate=True)
    assert run == pipeline.Run(1, 4, 2, 2)
    assert spark.table(f"{database}.vote_records").count() == 4


def test_a_rejected_file_leaves_the_tables_alone(spark, tmp_path, database):
    now = datetime.now()
    write(tmp_path, "one.csv", *lines(VOTERS), mtime=now.timestamp() - 3600)
    pipeline.load_voters(spark, str(tmp_path), database, now)
    write(tmp_path, "fine.csv", *lines([("11", *VOTERS[1][1:])]), mtime=now.timestamp() + 3600)
    write(tmp_path, "empty.csv", header=None, mtime=now.timestamp() + 3600)
    with pytest.raises(RejectedFiles, match="empty.csv"):
        pipeline.load_voters(spark, str(tmp_path), database, now)
    assert spark.table(f"{database}.vote_records").count() == 10


def test_no_file_at_all(spark, tmp_path, database):
    assert pipeline.load_voters(spark, str(tmp_path), database, DAY1) == pipeline.Run(0, 0, 0, 0)


def test_publish_keeps_the_old_version_when_a_contract_breaks(spark, database):
    name = f"{database}.processing_metadata"
    row = spark.createDataFrame([(1, DAY1, 1, 1, 1, 1, DAY1, DAY1)], schemas.RUN_METADATA.schema)
    publish(spark, row, name, schemas.RUN_METADATA)
    with pytest.raises(ContractError, match="unique"):
        publish(spark, row.unionByName(row), name, schemas.RUN_METADATA)
    assert current(spark, name).count() == 1
    for n in range(2, 5):
        publish(spark, current(spark, name).withColumn("files_processed", F.lit(n)), name, schemas.RUN_METADATA)
    assert current(spark, name).first().files_processed == 4
    versions = spark.sql(f"SHOW TABLES IN {database} LIKE 'processing_metadata__v*'").count()
    assert versions == 2


def test_bucketed_stage_counts_voters_without_moving_them(spark, database, sf):
    from ballotlake.registry import _stage

    publish(spark, _stage(spark, sf), f"{database}.stage", None, (), "voter_id", 8)
    stage = current(spark, f"{database}.stage")
    plan = stage.groupBy("state").agg(F.count_distinct("voter_id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_stream_loads_each_file_once(spark, tmp_path):
    folder, raw, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "checkpoint"))
    os.makedirs(folder)
    assert read_raw(spark, raw) is None

    def run():
        ingest_stream(spark, folder, raw, checkpoint, DAY1)
        return sorted((r.source_id, r.source_file) for r in read_raw(spark, raw).collect())

    write(tmp_path / "in", "a 1.csv", *lines(VOTERS[:2] + VOTERS[:1]))
    first = run()
    assert first == [("1", "a 1.csv"), ("1", "a 1.csv"), ("2", "a 1.csv")]
    assert run() == first
    write(tmp_path / "in", "b.csv", *lines(VOTERS[1:3]))
    assert run() == [*first, ("3", "b.csv")]


def test_the_stream_reads_headers_and_rejects_bad_files(spark, tmp_path):
    from ballotlake.constants import VOTER_COLUMNS
    from test_ingest import BOB

    folder, raw, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "checkpoint"))
    os.makedirs(folder)
    write(tmp_path / "in", "a.csv", BOB)
    write(tmp_path / "in", "b.csv", ",".join(reversed(("2" + BOB[1:]).split(","))), header=",".join(reversed(VOTER_COLUMNS)))
    write(tmp_path / "in", "c.csv", '3,"Two\nlines"' + BOB[5:])
    ingest_stream(spark, folder, raw, checkpoint, DAY1)
    rows = {r.source_id: (r.first_name, r.last_name, r.age) for r in read_raw(spark, raw).collect()}
    assert rows == {"1": ("Bob", "Lee", 30), "2": ("Bob", "Lee", 30), "3": ("Two\nlines", "Lee", 30)}
    write(tmp_path / "in", "short.csv", "9,Bob", header="id,first_name")
    with pytest.raises(Exception, match="short.csv: too few header columns"):
        ingest_stream(spark, folder, raw, checkpoint, DAY1)
    assert read_raw(spark, raw).count() == 3


def test_a_batch_opens_only_the_partitions_of_its_keys(spark, tmp_path):
    from ballotlake.plans.ingest import raw_records
    from ballotlake.sources import voter_files
    from ballotlake.streaming import voter_stream as stream
    from test_ingest import BOB

    folder, raw, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "checkpoint"))
    os.makedirs(folder)
    write(tmp_path / "in", "a.csv", *[f"{i}{BOB[1:]}" for i in range(2000)])
    assert [b.new_records for b in ingest_stream(spark, folder, raw, checkpoint, DAY1)] == [2000]
    stored = read_raw(spark, raw)
    assert len({f.rsplit("/", 2)[1] for f in stored.inputFiles()}) == stream.KEY_PARTS
    write(tmp_path / "in", "b.csv", *[f"{i}{BOB[1:]}" for i in (7, 2001, 2002)])
    rows = voter_files.clean_voters(voter_files.read_voter_files(spark, [f"{folder}/b.csv"]))
    records = raw_records(rows, DAY1)
    chosen = stream.stored_for(stored, records, 1)
    parts = {r.part for r in records.select(stream.key_part("record_hash").alias("part")).collect()}
    opened = chosen.select(F.input_file_name().alias("name")).distinct().collect()
    assert {int(r.name.split("key_part=")[1].split("/")[0]) for r in opened} == parts and len(parts) <= 3
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "key_part" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert [b.new_records for b in ingest_stream(spark, folder, raw, checkpoint, DAY1)] == [2]
    assert read_raw(spark, raw).count() == 2002


def test_the_stream_reports_empty_columns_and_unread_cells(spark, tmp_path):
    folder, raw, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "checkpoint"))
    os.makedirs(folder)
    write(tmp_path / "in", "a.csv", "1,Bob,Lee,old,,CA,I,b@x.com,2020-13-01,2022-01-01", "2,Al,Lee,30,,CA,I,a@x.com,2020-01-01,")
    (batch,) = ingest_stream(spark, folder, raw, checkpoint, DAY1)
    assert batch.warnings == ("gender: empty",) and batch.unread_cells == 2
    assert ingest_stream(spark, folder, raw, checkpoint, DAY1) == []


def test_a_seed_is_readable_when_its_replacement_is_cut_off(spark, tmp_path, monkeypatch):
    from ballotlake.operators import sinks

    path = str(tmp_path / "seed")
    rows = lambda n: spark.range(n).select(F.col("id").cast("string"))
    read = lambda: spark.read.option("header", "true").csv(sinks.latest_csv(spark, path)).count()
    assert sinks.csv_sink(rows(3), path) and read() == 3
    true_rename = sinks._rename

    def lost(files, source, target):
        if str(target).endswith("/seed"):
            raise KeyboardInterrupt  # the driver goes down between the two steps
        true_rename(files, source, target)

    monkeypatch.setattr(sinks, "_rename", lost)
    with pytest.raises(KeyboardInterrupt):
        sinks.csv_sink(rows(4), path)
    assert not os.path.exists(path) and read() == 3

    def refused(files, source, target):
        if "before" not in str(target) and "before" not in str(source):
            raise OSError("refused")
        true_rename(files, source, target)

    monkeypatch.setattr(sinks, "_rename", true_rename)
    assert sinks.csv_sink(rows(5), path) and read() == 5
    monkeypatch.setattr(sinks, "_rename", refused)
    with pytest.raises(OSError):
        sinks.csv_sink(rows(6), path)
    assert os.path.exists(path) and read() == 5
    assert not sinks.csv_sink(rows(0), path) and read() == 5


def test_a_raw_table_that_cannot_be_read_is_not_taken_for_none(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_raw(spark, str(tmp_path / "raw")).count()


def test_a_repeated_batch_leaves_no_row_twice(spark, tmp_path):
    folder, raw, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "checkpoint"))
    os.makedirs(folder)
    write(tmp_path / "in", "a.csv", *lines(VOTERS))
    ingest_stream(spark, folder, raw, checkpoint, DAY1)
    # The batch was written, but the stream went down before it could note that.
    for entry in os.scandir(f"{checkpoint}/commits"):
        os.unlink(entry.path)
    ingest_stream(spark, folder, raw, checkpoint, DAY1)
    assert read_raw(spark, raw).count() == len(VOTERS)


def test_calendar_seeds(spark, tmp_path):
    names = schemas.RESULTS_FILE.fieldNames()
    cells = {"year": "2020", "state": '"OHIO"', "state_po": "OH", "office": "US PRESIDENT", "candidate": '"X, ""Y"""',
             "candidatevotes": "5", "totalvotes": "9", "party_simplified": "OTHER"}
    (tmp_path / "r.tsv").write_text("\t".join(names) + "\n" + "\t".join(cells.get(n, "") for n in names) + "\n")
    (tmp_path / "c.json").write_text(json.dumps({"elections": [{"id": "1", "name": "Runoff in TX", "electionDay": "2025-07-04"}]}))
    out, prefix = str(tmp_path / "seeds"), f"s{uuid.uuid4().hex[:8]}_"
    written = pipeline.build_calendars(spark, out, DAY1, str(tmp_path / "r.tsv"), str(tmp_path / "c.json"))
    assert written == ["elections_historic_raw", "election_outcome_federal_historic", "election_calendar_upcoming"]
    tables = pipeline.load_seeds(spark, out, written, prefix)
    assert tables["elections_historic_raw"].first().candidate == 'X, ""Y'
    assert tables["election_outcome_federal_historic"].first().winner_votes == 5
    upcoming = tables["election_calendar_upcoming"]
    assert upcoming.count() == 8 and upcoming.where("state = 'IN'").first().election_date == date(2025, 7, 4)
    for name in written:
        failed = pipeline.run_checks(tables[name], pipeline.checks.DECLARED[name](DAY1.date())).where("NOT passed").collect()
        assert failed == []
    for part in ("fact", "dim"):
        spark.sql(f"DROP DATABASE {prefix}{part} CASCADE")


def test_upserts_of_bucketed_tables_leave_the_target_where_it_is(spark, database, sf):
    from datetime import timedelta

    from ballotlake.plans import voters as people
    from ballotlake.registry import AS_OF, NOON, _raw

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = people.dim_upsert(None, _raw(spark, sf), AS_OF)
    dim = publish(spark, first, f"{database}.dim", None, (), "source_id", buckets)
    stage = publish(spark, people.stage_upsert(None, dim, NOON), f"{database}.stage", None, (), "voter_id", buckets)
    raw_only = people.dim_voter(_raw(spark, sf), AS_OF + timedelta(1))

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    again = people.dim_upsert(dim, _raw(spark, sf), AS_OF + timedelta(1))
    assert exchanges(again) == exchanges(raw_only)
    staged = people.stage_upsert(stage, dim, NOON + timedelta(days=1))
    assert exchanges(staged) == 0
    assert again.count() == dim.count()
