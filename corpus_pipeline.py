"""The corpus pipeline: quality rules, line removal, near-duplicates, decontamination, mix.

Each stage takes (spark, docs, folder of the other tables) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last keep the columns of documents. A stage's
folder is deleted once the next one is written; the last one's stays, for the result is read from it.

Defined results: null and empty texts and those of few words fail the base rules and go; a null lang or source
is a value like any other, a null source counts as no site; without labels only the base rules reject;
without benchmark items nothing is contaminated; equal rows are one near-duplicate group, of which one row stays;
an empty table gives no rows; further columns, whatever their names, go along up to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ballotlake.llm import decontaminate, line_spread, mixing, quality_rules, simhash_pivots
from ballotlake.llm.common import remove, scratch, table

STAGES = [
    ("quality rules", quality_rules.stage),
    ("line dedup", line_spread.stage),
    ("SimHash near-dedup", simhash_pivots.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("mixing sources to target weights", mixing.stage),
]

# The quality cutoffs and the SimHash links have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents in sf_dir."""
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        folder = scratch(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return docs
