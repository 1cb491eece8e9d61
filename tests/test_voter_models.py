from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ballotlake.plans import voters as people
from samples import AS_OF, EXPECTED, VOTERS, raw, voter


def by_id(df, key="source_id"):
    return {r[key]: r for r in df.collect()}


def test_sample_voters(spark):
    stage = people.stage_voter_metrics(people.dim_voter(raw(spark), AS_OF), AS_OF)
    got = {
        r.voter_id: (r.age_group, r.years_since_registered, r.elections_since_last_vote, r.voter_engagement_segment, r.last_vote_cycle_type)
        for r in stage.collect()
    }
    assert got == EXPECTED


def test_dimension_rules(spark):
    rows = [
        voter("same"), voter("same"),
        voter("case", email="A@X.com"), voter("case", email="a@x.COM"),
        voter("conflict"), voter("conflict", age=46),
        voter("null conflict"), voter("null conflict", last_voted_date=None),
        voter("invalid conflict"), voter("invalid conflict", party="Green"),
        voter(None), voter(None, age=50),
        voter("no age", age=None), voter("no gender", gender=None), voter("bad mail", email="x"),
        voter("long state", state="CAL"), voter("other party", party="Green"),
        voter("no date", registered_date=None), voter("child", age=12), voter("no name", first_name=None),
    ]
    assert set(by_id(people.dim_voter(raw(spark, rows), AS_OF))) == {"same", "case", "child", "no name"}


def test_minors_are_not_staged(spark):
    dim = people.dim_voter(raw(spark, [voter("a", age=17), voter("b", age=18)]), AS_OF)
    assert set(by_id(people.stage_voter_metrics(dim, AS_OF), "voter_id")) == {"b"}


def test_a_second_run_on_the_same_day_changes_nothing(spark):
    first = people.dim_upsert(None, raw(spark), AS_OF)
    again = people.dim_upsert(first, raw(spark, [voter("1", age=99), voter("new")]), AS_OF)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, first.collect()), key=str)


def test_a_run_on_the_next_day_rewrites_valid_rows_and_keeps_the_others(spark):
    first = people.dim_upsert(None, raw(spark), AS_OF)
    tomorrow = AS_OF + timedelta(1)
    rows = VOTERS[1:] + [voter("1"), voter("1", age=99), voter("new")]
    second = by_id(people.dim_upsert(first, raw(spark, rows), tomorrow))
    assert set(second) == {v[0] for v in VOTERS} | {"new"}
    assert second["1"].last_modified_date == AS_OF and second["1"].age == 18
    assert second["2"].last_modified_date == tomorrow
    assert second["new"].inserted_date == tomorrow


def test_an_empty_dimension_takes_every_row(spark):
    empty = people.dim_voter(raw(spark), AS_OF).where("false")
    assert people.dim_upsert(empty, raw(spark), AS_OF).count() == len(VOTERS)


def test_stage_takes_only_rows_younger_than_its_last_run(spark):
    dim = people.dim_voter(raw(spark), AS_OF)
    noon = datetime(2025, 6, 30, 12)
    first = people.stage_upsert(None, dim, noon)
    assert people.stage_updates(first, dim, noon + timedelta(hours=1)).count() == 0
    later = people.dim_voter(raw(spark, [voter("1", age=70), voter("new")]), AS_OF + timedelta(1))
    second = by_id(people.stage_upsert(first, later, noon + timedelta(days=1)), "voter_id")
    assert second["1"].age_group == "65+" and second["1"].last_processed_date == noon + timedelta(days=1)
    assert second["2"].last_processed_date == noon
    assert "new" in second


def test_an_empty_stage_stays_empty_unless_asked(spark):
    dim = people.dim_voter(raw(spark), AS_OF)
    noon = datetime(2025, 6, 30, 12)
    empty = people.stage_voter_metrics(dim, AS_OF, noon).where("false")
    assert people.stage_upsert(empty, dim, noon).count() == 0
    assert people.stage_upsert(empty, dim, noon, process_when_empty=True).count() == len(VOTERS)


def test_upsert_refuses_other_columns(spark):
    import pytest

    dim = people.dim_voter(raw(spark), AS_OF)
    with pytest.raises(ValueError, match="columns changed"):
        people.upsert(dim, dim.withColumn("extra", F.lit(1)), "source_id")
