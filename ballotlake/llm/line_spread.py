"""Removal of lines that stand on many sites.

Every line with a word is hashed. A HyperLogLog sketch of the sites per line hash is merged by
aggregation; lines estimated at half to twice the threshold get an exact distinct count, lines
above that band are spread for certain, lines below it are not. Of a line found on the threshold's number of
sites or more, the document with the smallest doc_id keeps it and all others lose it, so that no text is
lost altogether.

The threshold is `SITES` sites, or where there are fewer the share `SHARE` of all sites, but `FLOOR` at least. Lines
that are looked for are few and sent to every task while they are at most `FEW`; more are joined by shuffling,
each with `SALTS` copies, so that no task gets all rows of a line.

Defined results: a null text stays null; a null source counts as no site; rows that share the keeping
doc_id all keep the line; lines without a word are never removed; an empty table gives no rows. All
input columns come back; `n_chars`, where there is one, follows the new text.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm import common

SITES, SHARE, FLOOR = 10, 0.5, 3
FEW, SALTS = 200_000, 16
SKETCH_ERROR = 0.14  # relative standard error: 64 registers of a line's sketch


def lines(docs: DataFrame, site: str = "source") -> DataFrame:
    """line (hash), site, doc_id of every line with a word."""
    return docs.select("doc_id", F.col(site).alias("site"), F.explode(F.split("text", "\n", -1)).alias("body")).filter(
        F.col("body").rlike(r"[^\x20\x09-\x0D]")
    ).select(F.xxhash64("body").alias("line"), "site", "doc_id")


def threshold(docs: DataFrame, site: str = "source") -> int:
    """From how many sites on a line is spread."""
    sites = docs.agg(F.count_distinct(site)).first()[0]
    return max(FLOOR, min(SITES, math.ceil(SHARE * sites)))


def among(found: DataFrame, chosen: DataFrame, how: str, few: int = FEW) -> DataFrame:
    """found joined with chosen lines, a row each: a line of a third of all rows is no task's alone."""
    if chosen.count() <= few:
        return found.join(F.broadcast(chosen), "line", how)
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "site"), F.lit(SALTS)).cast("int"))
    copies = chosen.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["line", "_salt"], how).drop("_salt")


def spread_lines(found: DataFrame, min_sites: int, few: int = FEW) -> DataFrame:
    """line, keeper (smallest doc_id) of the lines on min_sites sites or more."""
    sketched = common.settled(
        found.groupBy("line")
        .agg(F.approx_count_distinct("site", SKETCH_ERROR).alias("sites"), F.min("doc_id").alias("keeper"))
        .filter(F.col("sites") >= min_sites / 2)
    )
    certain = sketched.filter(F.col("sites") > 2 * min_sites).select("line", "keeper")
    near = sketched.filter(F.col("sites") <= 2 * min_sites).select("line", "keeper")
    # One row per line and site before the count, so that a line of a third of all rows stays small.
    exact = (
        among(found, near.select("line"), "left_semi", few).filter(F.col("site").isNotNull())
        .groupBy("line", "site").agg(F.lit(1).alias("one"))
        .groupBy("line").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites)
    )
    return certain.unionByName(near.join(exact.select("line"), "line", "left_semi"))


def remove_spread_lines(docs: DataFrame, min_sites: int | None = None, few: int = FEW) -> DataFrame:
    """docs without those lines, all columns, and `_removed`: how many lines went."""
    found = common.settled(lines(docs))
    spread = common.settled(spread_lines(found, min_sites or threshold(docs), few))
    marks = (
        among(found, spread, "inner", few).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("line").alias("_lines"))
        .hint("shuffle_hash")
    )
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    joined = rows.join(marks, F.col("_row.doc_id").eqNullSafe(F.col("_id")), "left").select(
        "_row", "_lines", F.split("_row.text", "\n", -1).alias("_all")
    )
    left = F.when(
        F.col("_lines").isNotNull(),
        F.filter("_all", lambda body: ~F.array_contains("_lines", F.xxhash64(body))),
    ).otherwise(F.col("_all"))
    cut = joined.select("_row", "_all", left.alias("_left"))
    text = F.when(F.size("_left") < F.size("_all"), F.array_join("_left", "\n")).otherwise(F.col("_row.text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("_left") < F.size("_all"), F.char_length(text)).otherwise(F.col("_row.n_chars"))
    kinds = dict(docs.dtypes)
    return cut.select(
        *[changed[c].cast(kinds[c]).alias(c) if c in changed else F.col("_row")[c].alias(c) for c in docs.columns],
        F.coalesce(F.size("_all") - F.size("_left"), F.lit(0)).cast("long").alias("_removed"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    result = remove_spread_lines(common.table(spark, folder, "documents"))
    return result.select("doc_id", "text", F.col("_removed").alias("n_removed"))


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return remove_spread_lines(docs).drop("_removed")
