import hashlib
import os
import random
from datetime import date, datetime, timezone

import pytest

from ballotlake.constants import VOTER_COLUMNS
from ballotlake.operators.dedup import keep_first, single_version, unseen_records
from ballotlake.plans import ingest
from ballotlake.sources import voter_files as files

HEADER = ",".join(VOTER_COLUMNS)
BOB = "1,Bob,Lee,30,M,CA,I,b@x.com,2020-01-01,2022-01-01"
NOW = datetime(2025, 6, 30)


def write(folder, name, *lines, header=HEADER, mtime=None):
    path = folder / name
    path.write_text("".join(line + "\n" for line in ([header] if header is not None else []) + list(lines)))
    if mtime:
        os.utime(path, (mtime, mtime))
    return str(path)


def scan(spark, folder, **options):
    return files.clean_voters(files.scan_voter_csv(spark, str(folder), **options))


def gate(spark, *paths):
    return {r.source_file: r for r in files.file_quality_gate(spark, list(paths)).collect()}


# --- gate ----------------------------------------------------------------------------------------
def test_gate(spark, tmp_path):
    empty_row = "," * 9
    got = gate(
        spark,
        write(tmp_path, "good.csv", BOB),
        write(tmp_path, "short.csv", "1,Bob", header="id,first_name"),
        write(tmp_path, "extra.csv", BOB + ",x", header=HEADER + ",ward"),
        write(tmp_path, "headed.csv"),
        write(tmp_path, "empty.csv", header=None),
        write(tmp_path, "five.csv", *[BOB] * 95, *[empty_row] * 5),
        write(tmp_path, "six.csv", *[BOB] * 94, *[empty_row] * 5, "NA,nan,,,,,,,,"),
        write(tmp_path, "blank lines.csv", "", BOB, "", BOB),
    )
    assert {name: row.can_process for name, row in got.items()} == {
        "good.csv": True, "short.csv": False, "extra.csv": True, "headed.csv": False, "empty.csv": False,
        "five.csv": True, "six.csv": False, "blank lines.csv": True,
    }
    assert got["short.csv"].error == "too few header columns"
    assert got["headed.csv"].error == "no data rows"
    assert (got["five.csv"].error_rows, got["five.csv"].total_rows, got["five.csv"].error_rate) == (5, 100, 0.05)
    assert got["six.csv"].error_rows == 6
    assert got["extra.csv"].extra_columns == 1
    assert got["blank lines.csv"].total_rows == 2


def test_gate_finds_the_header_of_a_split_file(spark, tmp_path):
    path = write(tmp_path, "long.csv", *[f"{i}{BOB[1:]}" for i in range(20000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        row = gate(spark, path)["long.csv"]
        assert tuple(row.header) == VOTER_COLUMNS and row.total_rows == 20000
        assert scan(spark, tmp_path).count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_bad_file_rejects_the_run(spark, tmp_path):
    write(tmp_path, "good.csv", BOB)
    write(tmp_path, "short.csv", "1,Bob", header="id,first_name")
    with pytest.raises(files.RejectedFiles, match="short.csv: too few header columns"):
        files.scan_voter_csv(spark, str(tmp_path))


def test_a_missing_column_rejects_the_run(spark, tmp_path):
    write(tmp_path, "renamed.csv", BOB, header=HEADER.replace("email", "mail"))
    with pytest.raises(files.RejectedFiles, match="missing columns email"):
        files.scan_voter_csv(spark, str(tmp_path))


def test_schema_check(spark):
    full = spark.createDataFrame([tuple(BOB.split(","))], list(VOTER_COLUMNS))
    assert files.schema_check(full).where("NOT valid").count() == 0
    lacking = files.schema_check(full.drop("email")).where("NOT valid").collect()
    assert [r.column_name for r in lacking] == ["email"]


# --- scan ----------------------------------------------------------------------------------------
def test_dirty_cells(spark, tmp_path):
    write(
        tmp_path, "dirty.csv",
        "1,  Ann  , nan,45.0,M,CA,I,a@x.com,2020-02-30,2020/01/02",
        '2,"Smith, Jr",None,x,F,NY,,"say ""hi""",2020-01-01,NA',
    )
    rows = {r.id: r for r in scan(spark, tmp_path).collect()}
    assert (rows["1"].first_name, rows["1"].last_name, rows["1"].age) == ("Ann", None, 45)
    assert rows["1"].registered_date is None and rows["1"].last_voted_date is None
    assert (rows["2"].first_name, rows["2"].last_name, rows["2"].age) == ("Smith, Jr", None, None)
    assert (rows["2"].party, rows["2"].email, rows["2"].last_voted_date) == (None, 'say "hi"', None)


def test_ragged_lines(spark, tmp_path):
    write(
        tmp_path, "ragged.csv",
        "short,Bob", BOB.replace("1,", "long,", 1) + ",x", BOB.replace("1,", "longer,", 1) + ",,,y",
        BOB.replace("1,", "one blank more,", 1) + ",", 'quoted,"a,b,c",Lee,30,M,CA,I,b@x.com,2020-01-01,2022-01-01',
        'short quoted,"a,b,c,d,e,f,g,h,i,j,k,l"', "", "," * 9, BOB,
        *[f"pad{i}{BOB[1:]}" for i in range(20)],
    )
    rows = scan(spark, tmp_path).collect()
    ids = {r.id for r in rows if not (r.id or "pad").startswith("pad")}
    assert ids == {"short", "quoted", "short quoted", "1"}
    assert sum(r.id is None for r in rows) == 1
    # Counting alone must see the same rows.
    assert scan(spark, tmp_path).count() == len(rows) == 25


def test_columns_are_found_by_name(spark, tmp_path):
    backwards = list(reversed(VOTER_COLUMNS))
    write(tmp_path, "a.csv", BOB)
    write(tmp_path, "b.csv", ",".join(reversed(BOB.split(","))), header=",".join(backwards))
    write(tmp_path, "c.csv", "w," + BOB + ",z", header="ward," + HEADER + ",zone")
    write(tmp_path, "d.csv", BOB + ",", header=HEADER + ",")
    rows = scan(spark, tmp_path).select(*VOTER_COLUMNS).collect()
    assert len(rows) == 4 and len(set(rows)) == 1


def test_names_with_blanks(spark, tmp_path):
    write(tmp_path, "new voters 1%.csv", BOB)
    rows = scan(spark, tmp_path)
    assert rows.count() == 1
    listed = files.scan_new_files(spark, str(tmp_path)).first()
    assert listed.source_file == "new voters 1%.csv" and listed.file_bytes > 0


def test_only_newer_csv_files_oldest_first(spark, tmp_path):
    write(tmp_path, "b.csv", BOB, mtime=2000)
    write(tmp_path, "a.csv", BOB, mtime=3000)
    write(tmp_path, "old.csv", BOB, mtime=1000)
    write(tmp_path, "notes.txt", BOB, mtime=4000)
    since = datetime.fromtimestamp(1000, timezone.utc)
    assert [r.source_file for r in files.scan_new_files(spark, str(tmp_path), since).collect()] == ["b.csv", "a.csv"]
    assert files.scan_new_files(spark, str(tmp_path)).count() == 3
    assert files.scan_voter_csv(spark, str(tmp_path), datetime.fromtimestamp(3000, timezone.utc)) is None


def test_any_number_of_columns_and_repeated_names(spark, tmp_path):
    extra = ",".join(f"x{i}" for i in range(60))
    write(tmp_path, "wide.csv", BOB + "," + extra, header=HEADER + "," + extra)
    write(tmp_path, "twice.csv", BOB + ",99", header=HEADER + ",id")
    rows = scan(spark, tmp_path).select(*VOTER_COLUMNS).collect()
    assert len(rows) == 2 and len(set(rows)) == 1 and rows[0].id == "1"
    assert {r.header_columns for r in gate(spark, *map(str, tmp_path.iterdir())).values()} == {70, 11}


def test_names_that_look_like_patterns(spark, tmp_path):
    for name in ("v[1].csv", "v{a,b}.csv", "v?.csv", "v*.csv", "a+b c.csv"):
        write(tmp_path, name, BOB)
    assert sorted(r.source_file for r in scan(spark, tmp_path).collect()) == sorted(
        ["v[1].csv", "v{a,b}.csv", "v?.csv", "v*.csv", "a+b c.csv"])


def test_line_breaks_inside_quotes(spark, tmp_path):
    write(tmp_path, "broken.csv", '1,"Al\nice, the ""first""",Smith,30,M,CA,I,b@x.com,2020-01-01,2022-01-01', "2" + BOB[1:], "3,Short", BOB + ",x")
    write(tmp_path, "plain.csv", "4" + BOB[1:])
    got = gate(spark, *map(str, tmp_path.iterdir()))
    assert (got["broken.csv"].total_rows, got["broken.csv"].can_process) == (3, True)
    rows = {r.id: r for r in scan(spark, tmp_path).collect()}
    assert set(rows) == {"1", "2", "3", "4"}
    assert rows["1"].first_name == 'Al\nice, the "first"' and rows["1"].last_name == "Smith"
    assert rows["1"].source_file == "broken.csv"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        assert scan(spark, tmp_path).count() == 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def split_small(spark, size="300"):
    """Blocks of a few lines, and the setting before."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    return before


def test_a_file_with_broken_lines_is_split(spark, tmp_path):
    rows, expected = [], {}
    chance = random.Random(5)
    for i in range(900):
        kind, name = chance.randrange(8), f"Bob{i}"
        if kind == 0:
            name = f"A\nb{i}, ""x"
        elif kind == 1:
            name = f'say "{i}"\n\n"twice"\nand, more'
        elif kind == 2:
            name = "long\n" * 90 + f"{i}"
        cell = '"' + name.replace('"', '""') + '"' if kind < 4 else name
        if kind == 5:
            # A quote that does not begin a cell is a character like any other.
            name = cell = f'5" tall{i}'
        rows.append(f"{i},{cell},Lee,30,M,CA,I,b@x.com,2020-01-01,2022-01-01")
        expected[str(i)] = name
    write(tmp_path, "broken.csv", *rows)
    before = split_small(spark)
    try:
        lines = files.file_lines(spark.read.text(str(tmp_path / "broken.csv")))
        assert lines.rdd.getNumPartitions() > 100
        assert lines.select("block").distinct().count() > 100
        text = files.scan_voter_csv(spark, str(tmp_path))
        assert {r.id: r.first_name for r in text.collect()} == expected
        assert gate(spark, str(tmp_path / "broken.csv"))["broken.csv"].total_rows == 900
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_file_is_read_whole():
    import inspect

    assert "multiLine" not in inspect.getsource(files)


def test_a_broken_header_and_quotes_that_never_end(spark, tmp_path):
    broken = HEADER + ',"more\nof it"'
    write(tmp_path, "header.csv", BOB + ",Al", "2" + BOB[1:] + ',"Bea\nB"', header=broken)
    write(tmp_path, "open.csv", "3" + BOB[1:], '4,"Bob,Lee,30', "5" + BOB[1:], "", "6" + BOB[1:])
    # The record that never ends has too many cells; it does not take those before it along.
    assert gate(spark, str(tmp_path / "open.csv"))["open.csv"].total_rows == 1
    rows = {r.id: r.first_name for r in scan(spark, tmp_path).collect()}
    assert rows == {"1": "Bob", "2": "Bob", "3": "Bob"}


@pytest.mark.parametrize("size", ["64", "1000", "128MB"])
def test_states_of_lines_against_a_plain_reader(spark, tmp_path, size):
    """Lines of any kind, cut into blocks of any size, make the records that one pass over the file makes."""
    chance = random.Random(size)
    pieces = ["a", '"', '""', ",", '",', ',"', " ", "xy", '"b"', '"c",']
    lines = ["id,x"] + ["".join(chance.choice(pieces) for _ in range(chance.randrange(0, 9))) for _ in range(700)]
    (tmp_path / "odd.csv").write_text("".join(line + "\n" for line in lines))
    wanted, inside, kept = [], False, []
    for line in lines:
        kept.append(line)
        at = 0
        while True:
            if inside:
                while at < len(line) and not (line[at] == '"' and line[at + 1:at + 2] != '"'):
                    at += 2 if line[at] == '"' else 1
                if at >= len(line):
                    break
                inside = False
            else:
                while at < len(line) and line[at] in " \t":
                    at += 1
                if line[at:at + 1] == '"':
                    inside, at = True, at + 1
                    continue
            at = line.find(",", at) + 1
            if not at:
                break
        if not inside:
            wanted.append("\n".join(kept))
            kept = []
    wanted += ["\n".join(kept)] if kept else []
    before = split_small(spark, size)
    try:
        placed = files._placed(files.file_lines(spark.read.text(str(tmp_path / "odd.csv"))))
        found = files.whole_records(placed, placed.select("file_uri").distinct()).orderBy("place").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["value"] for r in found] == [w for w in wanted if w.strip(" ")]


def test_very_long_quoted_cells(spark, tmp_path):
    write(tmp_path, "long.csv", "1,\"" + "a\"\"" * 50_000 + "\"" + BOB[5:])
    assert len(scan(spark, tmp_path).first().first_name) == 100_000


def test_dates_with_a_time_part(spark, tmp_path):
    moments = ["2010-01-01 00:00:00", "2020-11-03T00:00:00", "2020-11-03T23:59:59.5Z", "2020-11-03 10:00+01:00", "2020-11-03 25:00", "2020-11-03x", "2020-11-031"]
    write(tmp_path, "d.csv", *[f"{i}," + BOB[2:].rsplit(",", 1)[0] + "," + m for i, m in enumerate(moments)])
    got = {r.id: r.last_voted_date for r in scan(spark, tmp_path).collect()}
    assert got == {"0": date(2010, 1, 1), "1": date(2020, 11, 3), "2": date(2020, 11, 3), "3": date(2020, 11, 3), "4": None, "5": None, "6": None}


# --- dedup ---------------------------------------------------------------------------------------
def test_a_second_load_adds_nothing(spark, tmp_path):
    write(tmp_path, "v.csv", "1,Sam,One,40,M,WA,R,s@x.com,2019-01-01,2020-01-01")
    first = ingest.ingest_voters(scan(spark, tmp_path), NOW)
    assert first.count() == 1 and first.columns == ingest.RAW_VOTERS.columns
    stored = first.cache()
    assert ingest.ingest_voters(scan(spark, tmp_path), NOW, stored).count() == 0
    assert ingest.ingest_voters(scan(spark, tmp_path), NOW, stored, truncate=True).count() == 1


def test_repeats_pass_inside_a_file_and_not_across_files(spark, tmp_path):
    other = BOB.replace("2022-01-01", "2024-01-01")
    write(tmp_path, "z first.csv", BOB, BOB, mtime=1000)
    write(tmp_path, "a second.csv", other, "2" + BOB[1:], mtime=2000)
    write(tmp_path, "b third.csv", "2" + BOB[1:], "3" + BOB[1:], mtime=2000)
    rows = ingest.ingest_voters(scan(spark, tmp_path), NOW).collect()
    assert sorted((r.source_id, r.last_voted_date) for r in rows) == [
        ("1", date(2022, 1, 1)), ("1", date(2022, 1, 1)), ("2", date(2022, 1, 1)), ("3", date(2022, 1, 1)),
    ]
    assert len({r.record_uuid for r in rows}) == 4


def test_unseen_records_against_brute_force(spark):
    chance = random.Random(7)
    new = [(str(min(chance.randrange(60), 20)), chance.randrange(4), i) for i in range(600)]
    stored = [str(chance.randrange(8)) for _ in range(200)] + [None]
    first = {}
    for key, at, _ in new:
        first[key] = min(at, first.get(key, at))
    expected = sorted(r for r in new if r[0] not in stored and r[1] == first[r[0]])
    frame = spark.createDataFrame(new, "record_hash string, at int, n int").repartition(5)
    existing = spark.createDataFrame([(s,) for s in stored], "record_hash string")
    got = unseen_records(frame, existing, file_order="at")
    assert sorted(map(tuple, got.collect())) == expected
    without = sorted(r for r in new if r[0] not in stored)
    assert sorted(map(tuple, unseen_records(frame, existing).collect())) == without
    alone = sorted(r for r in new if r[1] == first[r[0]])
    assert sorted(map(tuple, unseen_records(frame, None, file_order="at").collect())) == alone


def test_single_version_with_one_key_in_a_third_of_the_rows(spark):
    chance = random.Random(3)
    rows = [("hot" if i % 3 == 0 else str(chance.randrange(300)), chance.choice([1, 1, 2, None])) for i in range(3000)]
    rows += [("same", None)] * 1000
    versions = {}
    for key, value in rows:
        versions.setdefault(key, set()).add(value)
    got = single_version(spark.createDataFrame(rows, "id string, v int"), "id").collect()
    assert sorted(r.id for r in got) == sorted(k for k, v in versions.items() if len(v) == 1)


def test_keep_first(spark):
    rows = [("a", None, 2, "x"), ("a", None, 1, "y"), ("a", "s", 3, None), (None, None, 4, "z")]
    got = keep_first(spark.createDataFrame(rows, "k string, s string, n int, v string"), ["k", "s"], ["n"])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == [rows[1], rows[2], rows[3]]


# --- statistics ----------------------------------------------------------------------------------
def test_hash_of_a_record(spark, tmp_path):
    write(tmp_path, "v.csv", "1, Alice,Smith ,30,F,CA,I,A@example.com,2020-01-01,")
    row = ingest.ingest_voters(scan(spark, tmp_path), NOW).first()
    assert row.record_hash == hashlib.md5(b"1|alice|smith|a@example.com").hexdigest()


def test_metadata_keeps_its_creation_time(spark):
    raw = spark.createDataFrame([("1", "CA"), ("1", "NY"), (None, None)], "source_id string, state string")
    metrics = ingest.ingest_metrics(raw)
    assert tuple(metrics.first()) == (1, 2)
    first = ingest.run_metadata(None, metrics, datetime(2025, 1, 1), 1, 3)
    second = ingest.run_metadata(first, metrics, datetime(2025, 2, 1, 10, 30, 5), 2, 4)
    row = second.first()
    assert (row.created_at, row.updated_at) == (datetime(2025, 1, 1), datetime(2025, 2, 1, 10, 30, 5))
    assert (row.files_processed, row.records_processed, row.voter_count, row.state_count) == (2, 4, 1, 2)
    assert ingest.last_watermark(second) == datetime(2025, 2, 1, 10, 30, 5, tzinfo=timezone.utc)
    assert ingest.last_watermark(None) is None
    assert ingest.last_watermark(second.where("false"), NOW) == NOW
