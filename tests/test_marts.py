from datetime import date

import pytest
from pyspark.sql import functions as F

from ballotlake.plans import marts
from ballotlake.plans import voters as people
from ballotlake.registry import _stage
from samples import AS_OF, raw, voter


@pytest.fixture(scope="module")
def sample(spark):
    return people.stage_voter_metrics(people.dim_voter(raw(spark), AS_OF), AS_OF)


@pytest.fixture(scope="module")
def stage(spark, sf):
    return _stage(spark, sf).cache()


def test_state_summary_of_the_sample(sample):
    rows = {r.state: r for r in marts.state_summary(sample, AS_OF).collect()}
    assert len(rows) == 10 and all(r.total_registered_voters == 1 for r in rows.values())
    scores = {s: r.engagement_opportunity_score for s, r in rows.items()}
    assert scores == {**dict.fromkeys(["ME", "ND", "KS", "NM"], 60.0), **dict.fromkeys(["RI", "AK", "DE", "HI"], 30.0), "VT": 10.0, "UT": 0.0}
    leans = {s: r.partisan_lean for s, r in rows.items()}
    assert leans == {
        **dict.fromkeys(["UT", "ND", "RI", "HI"], "Lean Democrat"),
        **dict.fromkeys(["ME", "KS", "AK"], "Lean Republican"),
        **dict.fromkeys(["VT", "NM", "DE"], "Highly Competitive"),
    }


def test_small_segments_score_nothing(sample):
    rows = marts.targeting_opportunities(sample, AS_OF).collect()
    assert len(rows) == 10
    assert {(r.opportunity_score, r.targeting_tier) for r in rows} == {(0.0, "Monitor Only")}
    assert sorted(r.national_rank for r in rows) == list(range(1, 11))


def test_trends_of_one_voter(sample):
    rows = marts.partisan_trends(sample).where("state = 'KS'").orderBy("election_year").collect()
    assert [r.election_year for r in rows] == list(range(2008, 2025, 2))
    assert [r.estimated_voters for r in rows] == [0] * 7 + [1, 0]
    assert rows[7].participation_rate == 100.0 and rows[7].participation_rate_change_pts == 100.0
    assert rows[0].prev_eligible_voters is None and rows[2].prev_eligible_voters == 1


def test_cells_give_what_a_distinct_count_gives(stage):
    for mart in (marts.voter_snapshot, marts.targeting_opportunities, marts.state_summary):
        counted, distinct = mart(stage, AS_OF, one_row_per_voter=True), mart(stage, AS_OF)
        assert counted.schema.simpleString() == distinct.schema.simpleString()
        assert counted.exceptAll(distinct).count() == 0 and distinct.exceptAll(counted).count() == 0


def test_repeated_voters_are_counted_once(spark, sample):
    twice = sample.unionByName(sample)
    row = marts.state_summary(twice, AS_OF).where("state = 'UT'").first()
    assert (row.total_registered_voters, row.democrat_voters, row.pct_democrat) == (1, 2, 200.0)


def test_voters_without_a_group_value_form_a_group(spark):
    rows = [voter("a", last_voted_date=None), voter("b", last_voted_date=None)]
    stage = people.stage_voter_metrics(people.dim_voter(raw(spark, rows), AS_OF), AS_OF)
    for unique in (True, False):
        got = marts.voter_snapshot(stage, AS_OF, unique).collect()
        assert [(r.last_vote_cycle_type, r.total_voters, r.avg_elections_missed) for r in got] == [(None, 2, None)]


def test_snapshot_adds_up(stage):
    snapshot = marts.voter_snapshot(stage, AS_OF, True)
    parts = ("current_voters", "missed_last_voters", "occasional_voters", "infrequent_voters", "dormant_voters", "never_voted")
    total = sum(F.col(p) for p in parts)
    assert snapshot.where(total != F.col("total_voters")).count() == 0
    assert snapshot.agg(F.sum("total_voters")).first()[0] == stage.count()


def test_state_shares_add_up(stage):
    parties = F.col("pct_democrat") + F.col("pct_republican") + F.col("pct_independent")
    assert marts.state_summary(stage, AS_OF).where(F.abs(parties - 100) > 0.02).count() == 0


def literal_trends(stage):
    """Counts by expanding every voter over the cycles, and totals by a join."""
    rows = marts.voter_eligibility(stage)
    demo = rows.groupBy(*marts.DEMO_KEYS).agg(F.sum("was_registered").alias("d"), F.sum("likely_voted").alias("v"))
    party = (
        rows.groupBy(*marts.PARTY_KEYS)
        .agg(F.sum("was_registered").alias("eligible_voters"), F.sum("likely_voted").alias("estimated_voters"))
        .where("eligible_voters > 0")
    )
    return party.join(demo, list(marts.DEMO_KEYS))


def test_trends_equal_the_expanded_form(stage):
    trends = marts.partisan_trends(stage)
    joined = trends.join(literal_trends(stage), [*marts.PARTY_KEYS, "eligible_voters", "estimated_voters"])
    assert joined.count() == trends.count() == literal_trends(stage).count()
    wrong = joined.where(F.abs(F.col("pct_of_eligible_by_demo") - 100 * F.col("eligible_voters") / F.col("d")) > 0.0051)
    assert wrong.count() == 0


def test_overlapping_cycles_count_a_vote_in_each(spark):
    cycles = ((2020, "Presidential", date(2020, 11, 3)), (2021, "Midterm", date(2020, 12, 3)))
    rows = marts.cycle_counts(one_voter(spark, date(2020, 11, 3)), cycles).collect()
    assert sorted((r.election_year, r.estimated_voters) for r in rows) == [(2020, 1), (2021, 1)]


def one_voter(spark, last_voted):
    return people.stage_voter_metrics(people.dim_voter(raw(spark, [voter("a", last_voted_date=last_voted)]), AS_OF), AS_OF)


@pytest.mark.parametrize("number", [64, 200])
def test_any_number_of_cycles(spark, number):
    cycles = [(year, "Presidential", date(year, 6, 1)) for year in range(1900, 1900 + number)]
    stage = one_voter(spark, date(2022, 11, 8)).unionByName(one_voter(spark, date(1960, 6, 2)))
    counts = {r.election_year: (r.eligible_voters, r.estimated_voters) for r in marts.cycle_counts(stage, cycles).collect()}
    assert len(counts) == number
    assert {y: c for y, c in counts.items() if c != ((2 if y >= 2000 else 0), 0)} == {}
    voted = one_voter(spark, date(1900 + number - 1, 6, 30)).withColumn("registered_date", F.lit(date(1900, 1, 1)))
    last = marts.cycle_counts(voted, cycles).orderBy(F.desc("election_year")).first()
    assert (last.election_year, last.eligible_voters, last.estimated_voters) == (1900 + number - 1, 1, 1)


def test_ranks_are_the_sorted_order(spark):
    from ballotlake.operators.ranking import with_rank

    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 13).alias("score"))
    order = [F.desc("score"), F.asc("id")]
    ranked = with_rank(rows, order, "place")
    text = ranked._jdf.queryExecution().executedPlan().toString()
    assert ranked.orderBy("place").select("id").collect() == rows.orderBy(*order).select("id").collect()
    assert [r.place for r in ranked.orderBy("place").collect()] == list(range(1, 5001))
    assert "Exchange SinglePartition" not in text.split("BroadcastExchange")[0]
    assert with_rank(rows.where("id < 0"), order, "place").count() == 0


def test_ranks_break_ties_by_group(stage):
    rows = marts.targeting_opportunities(stage, AS_OF, True).collect()
    order = sorted(rows, key=lambda r: (-r.opportunity_score, -r.total_voters, r.state, r.age_group, r.gender, r.party))
    assert [r.national_rank for r in order] == list(range(1, len(rows) + 1))
    for state in {r.state for r in rows}:
        assert [r.state_rank for r in order if r.state == state] == list(range(1, 1 + sum(r.state == state for r in rows)))


def test_score_weights_and_tiers_are_parameters(stage):
    only_size = marts.targeting_opportunities(
        stage, AS_OF, True, weights=(0, 0, 0, 1000), min_scored_segment=1, tier_rules=(("Any", 0, 1),)
    )
    assert only_size.where(F.col("opportunity_score") != F.col("total_voters")).count() == 0
    assert {r.targeting_tier for r in only_size.collect()} == {"Any"}


def test_tiers(spark):
    rows = spark.createDataFrame([(25.0, 5), (25.0, 4), (14.9, 9), (8.0, 1), (0.0, 99)], "s double, n long")
    got = [r[0] for r in rows.select(marts.targeting_tier(F.col("s"), F.col("n"))).collect()]
    assert got == ["High Priority", "Medium Priority", "Low Priority", "Monitor Only", "Monitor Only"]


def test_leans(spark):
    rows = spark.createDataFrame([(50.0, 45.0), (50.0, 40.0), (60.0, 40.0), (40.0, 60.0)], "d double, r double")
    got = [r[0] for r in rows.select(marts.partisan_lean(F.col("d"), F.col("r"))).collect()]
    assert got == ["Highly Competitive", "Competitive", "Lean Democrat", "Lean Republican"]


def test_all_marts_share_the_cells(stage):
    built = marts.all_marts(stage, AS_OF, True)
    assert list(built) == list(marts.MARTS)
    assert built["state_summary"].agg(F.sum("total_registered_voters")).first()[0] == stage.count()
