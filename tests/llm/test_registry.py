"""The registered queries: names, SQL equivalents, the pipeline, and native plans."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry
import corpus_pipeline
from ballotlake.llm import oracles, registry
from ballotlake.llm.common import scratch, table


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(oracles.SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_gives_the_rows_of_its_sql(spark, sf, name):
    assert compare(registry.QUERIES[name](spark, sf), duck(sf), oracles.SQL[name]) == []


@pytest.mark.parametrize("name", ["op2_quality_rules", "op3_prefix_decontamination", "op6_pii_disclosure", "op10_line_spread"])
def test_native_plans(spark, sf, name):
    plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_pipeline_applies_its_stages(spark, sf):
    docs = table(spark, sf, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]
    columns, counts = docs.columns, [docs.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        folder = scratch(spark, f"test{number}")
        stage(spark, docs, sf).write.parquet(folder)
        docs = spark.read.parquet(folder)
        counts.append(docs.count())
        if number < 4:
            assert docs.columns == columns
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] == counts[5] > 0
    again = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))
