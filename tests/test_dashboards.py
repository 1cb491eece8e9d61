from datetime import date

from pyspark.sql import functions as F

from ballotlake.plans import dashboards as D


def test_scores_above_100_are_scaled_by_the_best(spark):
    fields = "state string, age_group string, gender string, party string, opportunity_score double, national_rank int, targeting_tier string"

    def shown(*scores):
        rows = [("CA", "65+", "F", "Democrat", s, i + 1, "High Priority") for i, s in enumerate(scores)]
        return [r.opportunity_score_display for r in D.top_targets(spark.createDataFrame(rows, fields)).collect()]

    assert shown(56.25, 40.0) == [0.562, 0.4]
    assert shown(200.0, 50.0) == [100.0, 25.0]
    assert len(shown(*map(float, range(30, 0, -1)))) == 10


def test_grid_takes_the_first_of_equal_states(spark):
    rows = [(f"S{i:02d}", 100 - i, 50.0, 12.34) for i in range(20)]
    fields = "state string, total_registered_voters long, engagement_opportunity_score double, pct_recoverable_voters double"
    grid = D.state_grid(spark.createDataFrame(rows, fields)).collect()
    assert [r.state for r in grid] == [f"S{i:02d}" for i in range(15)]
    assert [(r.grid_row, r.grid_col) for r in grid[:4]] == [(0, 0), (0, 1), (0, 2), (1, 0)]
    assert grid[0].label == "S00<br>12.3% rec<br>50.0 eng"


def test_rows_without_a_key_are_left_out(spark):
    rows = [("M", "Democrat", "Never Voted", 2), ("F", "Democrat", "Never Voted", 3), (None, "Democrat", "Never Voted", 9), ("M", None, "Never Voted", 9)]
    snapshot = spark.createDataFrame(rows, "gender string, party string, voter_engagement_segment string, total_voters long")
    (row,) = D.gender_engagement(snapshot).collect()
    assert (row.M, row.F, row.segment_order) == (-2, 3, 5)
    assert {(r.gender, r.total_voters, r.pct_of_gender) for r in D.gender_party(snapshot).collect()} == {("M", 2, 100.0), ("F", 3, 100.0)}


def test_registration_years(spark):
    rows = [(date(2020, 1, 1), "M", "Democrat", "65+"), (date(2020, 5, 1), "M", "Republican", "65+"), (None, "F", "Democrat", "18-29")]
    stage = spark.createDataFrame(rows, "registered_date date, gender string, party string, age_group string")
    assert [tuple(r) for r in D.registrations_by_year(stage).collect()] == [(2020, 2)]
    assert [tuple(r) for r in D.gender_by_year(stage).collect()] == [(2020, "Democrat", -1, 0), (2020, "Republican", -1, 0)]
    assert [tuple(r) for r in D.age_by_party(stage).collect()] == [("18-29", 1, 0, 0), ("65+", 1, 1, 0)]


def test_table_views(spark):
    states = spark.createDataFrame([("A", 1), ("B", 2)], "state string, total_registered_voters long")
    assert [r.state for r in D.states_by_size(states).collect()] == ["B", "A"]
    segments = spark.createDataFrame([("C", 1), ("B", 2), ("A", 1)], "state string, total_voters long")
    segments = segments.withColumns({key: F.lit("x") for key in D.SNAPSHOT_KEYS[1:]})
    assert [r.state for r in D.segments_by_size(segments).collect()] == ["B", "A", "C"]
    stage = spark.createDataFrame(
        [("a", None), ("c", date(2020, 1, 1)), ("b", date(2020, 1, 1))], "voter_id string, registered_date date")
    assert [r.voter_id for r in D.stage_by_registration(stage).collect()] == ["b", "c", "a"]
