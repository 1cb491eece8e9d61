import json
from datetime import date, datetime

import pytest

from ballotlake import schemas
from ballotlake.operators.sinks import csv_sink
from ballotlake.plans import calendars
from ballotlake.sources import election_files as files

AS_OF = date(2025, 6, 30)


def results(spark, rows, fields="year int, candidate string, party_simplified string, candidatevotes int, totalvotes int, seq long"):
    return spark.createDataFrame(rows, fields)


def test_start_year():
    assert calendars.calendar_years(date(2025, 6, 30)) == (2022, 2030)
    assert calendars.calendar_years(date(2021, 1, 1)) == (2020, 2030)
    assert calendars.calendar_years(date(2020, 1, 1)) == (2020, 2030)


def test_federal_calendar(spark):
    rows = calendars.federal_calendar(spark, 2022, 2028).orderBy("election_date").collect()
    assert [(r.election_date, r.election_type, r.state) for r in rows] == [
        (date(2022, 11, 8), "Midterm", None),
        (date(2024, 3, 5), "Primary", "Multiple"),
        (date(2024, 11, 5), "Presidential", None),
        (date(2026, 11, 3), "Midterm", None),
        (date(2028, 3, 7), "Primary", "Multiple"),
        (date(2028, 11, 7), "Presidential", None),
    ]
    assert rows[1].election_name == "2024 Super Tuesday Presidential Primary"


def test_winner_is_the_first_row_with_most_votes(spark):
    rows = [
        (2020, "A", "X", 5, 10, 3), (2020, "B", "Y", 7, 10, 2), (2020, "C", "Z", 7, 20, 1), (2020, "D", "Z", None, None, 0),
        (2016, "E", "W", None, 4, 5),
    ]
    got = {r.election_year: r for r in calendars.historic_outcomes(results(spark, rows)).collect()}
    assert (got[2020].winner_name, got[2020].winner_party, got[2020].winner_votes) == ("C", "Z", 7)
    assert got[2020].total_votes_cast == 40 and got[2020].election_date == date(2020, 11, 3)
    assert got[2016].winner_name is None and got[2016].total_votes_cast == 4


def test_party_column_is_chosen_by_presence(spark):
    rows = results(spark, [(2020, "A", "X", 5, 10, 3)])
    renamed = rows.withColumnRenamed("party_simplified", "party_detailed")
    assert calendars.historic_outcomes(renamed).first().winner_party == "X"
    assert calendars.historic_outcomes(rows.drop("party_simplified")).first().winner_party is None
    bare = calendars.historic_outcomes(rows.select("year", "seq")).first()
    assert (bare.winner_name, bare.total_votes_cast) == (None, None)


def civic(spark, *rows):
    return spark.createDataFrame([(str(i), n, d, i) for i, (n, d) in enumerate(rows)], "id string, name string, electionDay string, seq long")


def test_listings_win_over_the_schedule(spark):
    listed = civic(
        spark, ("2024 Presidential Election", "2024-11-05T00:00:00Z"), ("Federal Election again", "2024-11-05"),
        ("Runoff", "2024-11-05T00:00:00Z"),
    )
    got = calendars.upcoming_calendar(spark, AS_OF, listed)
    rows = [r for r in got.collect() if r.election_date == date(2024, 11, 5)]
    assert sorted((r.election_name, r.election_level) for r in rows) == [
        ("2024 Presidential Election", "Federal"), ("Runoff", "General"),
    ]
    assert got.count() == calendars.upcoming_calendar(spark, AS_OF).count() + 1


def test_elections_since_a_calendar(spark):
    voters = spark.createDataFrame([(date(2024, 11, 5),), (date(2024, 11, 4),), (date(2007, 1, 1),), (None,)], "last_voted_date date")
    calendar = calendars.federal_calendar(spark, 2008, 2024)
    got = [r.elections_in_calendar for r in calendars.elections_since(voters, calendar).collect()]
    assert got == [0, 1, 9, None]


def test_finalized_columns_and_types(spark):
    upcoming = calendars.finalize_calendar(calendars.upcoming_calendar(spark, AS_OF), datetime(2025, 6, 30, 1, 2, 3))
    names = [f.name for f in schemas.CALENDAR_COLUMNS if f.name not in ("total_votes_cast", "winner_name", "winner_party", "winner_votes")]
    assert upcoming.columns == names
    row = upcoming.first()
    assert row.last_updated == "2025-06-30 01:02:03+00:00" and len(row.election_id) == 36
    assert upcoming.select("election_id").distinct().count() == upcoming.count()
    historic = calendars.finalize_calendar(calendars.historic_outcomes(results(spark, [(2020, "A", "X", 5, 10, 3)])), datetime(2025, 6, 30))
    assert historic.schema.simpleString() == schemas.CALENDAR_COLUMNS.simpleString()
    both = calendars.unified_calendar(historic, upcoming)
    assert both.columns == names and both.count() == historic.count() + upcoming.count()


def test_results_file(spark, tmp_path):
    names = schemas.RESULTS_FILE.fieldNames()
    cells = {"year": "2020", "state": '"""OHIO"""', "candidate": '"O\'NEIL, "AL""', "candidatevotes": "5", "totalvotes": "NA"}
    good = "\t".join(cells.get(n, "") for n in names)
    first = "\t".join({**cells, "candidate": "FIRST"}.get(n, "") for n in names)
    path = tmp_path / "results.tsv"
    path.write_text("\n".join(["\t".join(names), first, good, good + "\tx", "2016\tshort"]) + "\n")
    rows = files.scan_results_tsv(spark, str(path)).orderBy("seq").collect()
    assert [(r.year, r.state) for r in rows] == [(2020, "OHIO"), (2020, "OHIO"), (2016, "short")]
    assert (rows[1].candidate, rows[1].candidatevotes, rows[1].totalvotes) == ('O\'NEIL, "AL', 5, None)
    assert files.scan_results_tsv(spark, str(path)).count() == 3
    outcome = calendars.historic_outcomes(files.scan_results_tsv(spark, str(path)))
    assert outcome.where("election_year = 2020").first().winner_name == "FIRST"


def test_civic_file(spark, tmp_path):
    path = tmp_path / "civic.json"
    path.write_text(json.dumps({"elections": [{"id": "1", "name": "a", "electionDay": "2025-01-01"}, {"id": "2", "name": "b"}]}))
    rows = files.scan_civic_json(spark, str(path)).orderBy("seq").collect()
    assert [(r.id, r.name, r.electionDay) for r in rows] == [("1", "a", "2025-01-01"), ("2", "b", None)]
    path.write_text(json.dumps({"elections": []}))
    assert files.scan_civic_json(spark, str(path)).count() == 0


def test_csv_sink_refuses_an_empty_dataset(spark, tmp_path):
    assert csv_sink(spark.range(0), str(tmp_path / "none")) is False
    assert not (tmp_path / "none").exists()
    tricky = spark.createDataFrame([('a "b", c', None)], "x string, y string")
    assert csv_sink(tricky, str(tmp_path / "some")) is True
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "some"))
    assert [tuple(r) for r in back.collect()] == [('a "b", c', None)]


def test_a_seed_with_a_wrong_type_fails(spark, tmp_path):
    (tmp_path / "s.csv").write_text("election_id,election_date\nx,not a date\n")
    contract = schemas.Contract("s", schemas._struct("election_id string\nelection_date date"))
    with pytest.raises(Exception):
        files.read_seed(spark, str(tmp_path / "s.csv"), contract).collect()


def test_by_source(spark):
    got = calendars.calendar_by_source(calendars.upcoming_calendar(spark, AS_OF)).collect()
    assert [(r.elections, r.first_date, r.last_date) for r in got] == [(7, date(2022, 11, 8), date(2030, 11, 5))]
