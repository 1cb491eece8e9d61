"""Physical plans: no Python workers, no Cartesian products, no more shuffles than needed."""

import re

import pytest

from ballotlake.plans import marts
from ballotlake.registry import QUERIES, _dim, _raw, _stage
from samples import AS_OF

FILE_QUERIES = {"scan_voter_csv", "scan_new_files", "file_quality_gate", "schema_check", "scan_results_tsv", "scan_civic_json", "seed_load", "catalog_tables", "csv_sink", "ingest_stream"}


@pytest.fixture(autouse=True, scope="module")
def nothing_cached(spark):
    """Plans would show what other modules cached."""
    spark.catalog.clearCache()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|single|round)", plan(df), re.I))


# Checks only aggregate tables that have queries, and so plans, of their own.
CHECKS = {name for name in QUERIES if name.startswith("dq_")} | {"contract_check"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FILE_QUERIES - CHECKS))
def test_no_python_and_no_product(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in text


def test_dimension_adds_one_shuffle(spark, sf):
    assert shuffles(_dim(spark, sf)) == shuffles(_raw(spark, sf)) + 1


def test_stage_adds_none(spark, sf):
    assert shuffles(_stage(spark, sf)) == shuffles(_dim(spark, sf))


def test_eligibility_adds_none(spark, sf):
    assert shuffles(marts.voter_eligibility(_stage(spark, sf))) == shuffles(_stage(spark, sf))


def test_voters_are_shuffled_once_per_mart(spark, sf):
    """Cells, groups and the final order; the distinct count adds none over voters already together."""
    base = shuffles(_stage(spark, sf))
    for mart in (marts.voter_snapshot, marts.state_summary):
        assert shuffles(mart(_stage(spark, sf), AS_OF, one_row_per_voter=True)) <= base + 3


def test_scans_read_only_the_columns_used(spark, sf):
    text = plan(marts.state_summary(_stage(spark, sf), AS_OF, one_row_per_voter=True))
    assert "c_acctbal" not in text and "o_totalprice" not in text
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in text
