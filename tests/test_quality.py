from datetime import date

import pytest
from pyspark.sql import functions as F

from ballotlake import schemas
from ballotlake.operators import quality as Q
from ballotlake.plans import checks
from ballotlake.plans import voters as people
from samples import AS_OF, raw


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", 1, date(2020, 1, 1)), ("a", 5, None), ("b", None, date(2030, 1, 1)), (None, 9, None), (None, 9, None)]
    return spark.createDataFrame(rows, "k string, n int, d date")


def outcome(df, *checked):
    return [(r.check_name, r.column_name, r.total_rows, r.failing_rows, r.passed) for r in Q.run_checks(df, list(checked)).collect()]


@pytest.mark.parametrize(
    "check, failing",
    [
        (lambda: Q.not_null("k")[0], 2),
        (lambda: Q.unique("k")[0], 1),
        (lambda: Q.unique("d")[0], 0),
        (lambda: Q.unique_combination("k", "n"), 1),
        (lambda: Q.accepted_values("k", ["a"]), 1),
        (lambda: Q.accepted_values("n", [1, 5], F.col("n") < 9), 0),
        (lambda: Q.between("n", 1, 5), 2),
        (lambda: Q.between("d", date(2000, 1, 1), date(2025, 1, 1)), 1),
        (lambda: Q.matches("k", "^a$"), 1),
        (lambda: Q.length_equals("k", 1), 0),
        (lambda: Q.length_between("k", 2, 3), 3),
        (lambda: Q.at_least("n", "n"), 0),
        (lambda: Q.RowCountCheck(1, 4), 1),
        (lambda: Q.RowCountCheck(5, 5), 0),
        (lambda: Q.ColumnsCheck(("k", "n", "d")), 0),
        (lambda: Q.ColumnsCheck(("n", "k", "d")), 1),
    ],
)
def test_check(table, check, failing):
    ((_, _, total, found, passed),) = outcome(table, check())
    assert (total, found, passed) == (5, failing, failing == 0)


def test_pair_order_with_condition(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 2), (None, 2), (0, 9)], "a int, b int")
    assert outcome(pairs, Q.at_least("a", "b", F.col("a") > 0))[0][3] == 1


def test_checks_of_an_empty_table(table):
    got = outcome(table.where("false"), *Q.not_null("k"), *Q.unique("k"), Q.RowCountCheck(1, 2))
    assert [(r[2], r[3]) for r in got] == [(0, 0), (0, 1), (0, 0)]


def test_declared_checks_of_the_sample(spark):
    dim = people.dim_voter(raw(spark), AS_OF)
    stage = people.stage_voter_metrics(dim, AS_OF)
    for df, name in ((dim, "dim_voter"), (stage, "stage_voter_metrics")):
        assert Q.run_checks(df, checks.DECLARED[name](AS_OF)).where("NOT passed").collect() == []


def test_number_of_declared_checks():
    def count(name, *tables):
        return sum(len(checks.of_kind(checks.DECLARED[t](AS_OF), name)) for t in tables)

    models = [t for t in checks.DECLARED if not t.startswith("election")]
    seeds = [t for t in checks.DECLARED if t.startswith("election")]
    kinds = ("not_null", "unique", "accepted_values", "between", "matches_regex", "length_equals", "length_between", "at_least")
    assert [count(k, *models) for k in kinds] == [51, 3, 22, 56, 3, 5, 2, 1]
    assert [count(k, *seeds) for k in kinds[:3]] == [23, 2, 9]
    assert count("unique_combination", *seeds) == 1
    assert count("row_count_between", *models) == count("columns_match", *models) == 1


def test_contracts(spark):
    dim = people.dim_voter(raw(spark), AS_OF)
    assert Q.enforce_contract(dim, schemas.DIM_VOTER) is dim
    with pytest.raises(Q.ContractError, match="unique.source_id.: 10"):
        Q.enforce_contract(dim.unionByName(dim), schemas.DIM_VOTER)
    with pytest.raises(Q.ContractError, match="age"):
        Q.enforce_contract(dim.withColumn("age", F.col("age").cast("long")), schemas.DIM_VOTER)
    with pytest.raises(Q.ContractError, match="columns"):
        Q.enforce_contract(dim.drop("last_modified_date"), schemas.DIM_VOTER)
    nameless = dim.withColumn("first_name", F.lit(None).cast("string"))
    with pytest.raises(Q.ContractError, match="not_null.first_name.: 10"):
        Q.enforce_contract(nameless, schemas.DIM_VOTER)
    Q.enforce_contract(nameless, schemas.DIM_VOTER, waived=("first_name",))


def test_number_of_contract_constraints():
    models = ("dim_voter", "stage_voter_metrics", "voter_snapshot", "partisan_trends", "targeting_opportunities", "state_summary")
    assert sum(len(schemas.CONTRACTS[m].required) for m in models) == 72
    assert sum(len(schemas.CONTRACTS[m].unique) for m in models) == 3
