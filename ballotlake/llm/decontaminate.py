"""Benchmark passages in documents, found by a prefix-filtered set join.

An item's windows are its runs of 13 words (a shorter item is one window). For a window to stand in a
document all its words must, so one necessary word is enough as prefix: the rarest one by the counts
of the whole corpus. Documents are joined on those words; a candidate survives when the window fits
into the document around the word (length and positional bounds) and the window's second-rarest word
is where it belongs, and is then verified word by word.

The corpus is read twice, whatever the size of the benchmark: once for counts, once for the join. Up to `BLOCK`
windows are sent to every task, and the rows of documents are not shuffled, only what matched. More windows
are joined by shuffling: a document word is moved, with its neighbourhood, only if a bit map of `BITS` bits
has the bit of its code, and the bit map (at most BITS / 64 rows) is all that is broadcast.

Defined results: a null or empty text, or one without words, has no hits; an item without words has no
window; a null item_id counts as one item with an empty name; equal rows of documents count once each
and get equal results; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm import common

WINDOW = 13
BLOCK = 100_000  # windows, each of at most WINDOW words, sent to the executors at most
BITS = 1 << 24  # of the bit map that larger sets of codes are looked up in


def windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, tokens) and the items they belong to (window, item)."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        common.plain_words(common.whole()).alias("tokens"),
    ).filter(F.size("tokens") > 0)
    last = F.greatest(F.size("tokens") - size + 1, F.lit(1))
    placed = items.select(
        "item", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("tokens", i, size))).alias("tokens")
    ).select(F.sha2(F.array_join("tokens", " "), 256).alias("window"), "item", "tokens")
    return (
        placed.groupBy("window").agg(F.first("tokens").alias("tokens")),
        placed.select("window", "item").distinct(),
    )


def bit_map(codes: DataFrame) -> DataFrame:
    """_slot, _mask: which remainders of codes there are, 64 to a row."""
    bit = F.pmod("code", F.lit(BITS))
    return codes.select(F.shiftright(bit, 6).alias("_slot"), F.expr("shiftleft(1L, cast(pmod(code, 64) as int))").alias("_bit")).groupBy(
        "_slot").agg(F.bit_or("_bit").alias("_mask"))


def may_have(words: DataFrame, codes: DataFrame) -> DataFrame:
    """words (with `code`) and `_may`: whether the code is among codes; a few others pass as well."""
    looked = words.withColumn("_slot", F.shiftright(F.pmod("code", F.lit(BITS)), 6)).join(F.broadcast(bit_map(codes)), "_slot", "left")
    may = F.expr("(shiftright(_mask, cast(pmod(code, 64) as int)) & 1L) = 1L")
    return looked.withColumn("_may", F.coalesce(may, F.lit(False))).drop("_slot", "_mask")


def rare_first(distinct: DataFrame, docs: DataFrame, block_size: int = BLOCK) -> DataFrame:
    """The windows with their rarest word (prefix) and the next rarest, and where they stand."""
    spots = distinct.select("window", F.posexplode("tokens").alias("spot", "word"))
    vocabulary = common.settled(spots.select(F.xxhash64("word").alias("code")).distinct())
    corpus = docs.select(F.explode(common.plain_words(common.whole())).alias("w")).select(F.xxhash64("w").alias("code"))
    if vocabulary.count() <= block_size:
        counts = corpus.join(F.broadcast(vocabulary), "code", "left_semi").groupBy("code").count()
    else:
        counts = may_have(corpus, vocabulary).filter("_may").groupBy("code").count()
    ranked = spots.withColumn("code", F.xxhash64("word")).join(counts, "code", "left").groupBy("window").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "spot", "word"))).alias("order")
    )
    first, second = F.get("order", F.lit(0)), F.coalesce(F.get("order", F.lit(1)), F.get("order", F.lit(0)))
    # A word that the corpus lacks rules its window out before any join.
    return distinct.join(
        ranked.filter(first["n"] > 0).select(
            "window",
            F.xxhash64(first["word"]).alias("code"), first["spot"].alias("spot"),
            second["word"].alias("next_word"), second["spot"].alias("next_spot"),
        ),
        "window",
    )


def _near(docs: DataFrame, prefix: DataFrame, size: int, sent: bool) -> DataFrame:
    """doc_id, _key, n, at, part, base, and the columns of a window whose prefix stands at word `at`.

    part holds words of the document from word `base` on, all that a window around `at` can take. Every
    document has a row at least.
    """
    rows = docs.select(
        "doc_id", common.content_key().alias("_key"), common.plain_words(common.whole()).alias("body")
    ).select("doc_id", "_key", "body", F.size("body").alias("n"), F.posexplode_outer("body").alias("at", "word"))
    rows = rows.withColumn("code", F.xxhash64("word"))
    if sent:
        found = rows.join(F.broadcast(prefix.withColumnRenamed("code", "_code")), F.col("_code") == F.col("code"), "left")
        return found.withColumns({"part": F.col("body"), "base": F.lit(0)})
    kept = may_have(rows, prefix.select("code")).filter(F.col("_may") | (F.coalesce("at", F.lit(0)) == 0))
    base = F.greatest(F.col("at") - (size - 1), F.lit(0))
    # Words that only stand for their document are dealt by the document; they meet no window.
    moved = kept.select(
        "doc_id", "_key", "n", "at", F.when(F.col("_may"), F.slice("body", base + 1, F.lit(2 * size - 1))).alias("part"), base.alias("base"),
        F.when(F.col("_may"), F.col("code")).otherwise(F.xxhash64("doc_id", "_key")).alias("code"))
    return moved.join(prefix, "code", "left")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_size: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, _key, n_words, n_hit, items (sorted), hits (spans of words)."""
    distinct, owners = windows(benchmark, size)
    distinct = common.settled(distinct)
    prefix = common.settled(rare_first(distinct, docs, block_size))
    near = _near(docs, prefix, size, distinct.count() <= block_size)
    start = F.col("at") - F.col("spot")
    length = F.size("tokens")
    holds = (
        F.col("window").isNotNull() & F.col("part").isNotNull()
        & (length <= F.col("n")) & (start >= 0) & (start + length <= F.col("n"))
        & (F.get("part", start - F.col("base") + F.col("next_spot")) == F.col("next_word"))
        & (F.slice("part", F.greatest(start - F.col("base"), F.lit(0)) + 1, length) == F.col("tokens"))
    )
    # The first word of each document stays as well, so that one pass gives every document a row.
    found = (
        near.select("doc_id", "_key", "n", "at", "window", F.coalesce(holds, F.lit(False)).alias("hit"),
                    start.alias("start"), length.alias("length"))
        .filter(F.col("hit") | (F.coalesce("at", F.lit(0)) == 0))
        .select("doc_id", "_key", "n",
                F.when(F.col("hit"), F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("span"),
                F.when(F.col("hit"), F.col("window")).alias("window"))
    )
    gathered = found.groupBy("doc_id", "_key").agg(
        F.max("n").cast("long").alias("n_words"),
        F.sort_array(F.collect_set("span")).alias("hits"),
        F.collect_set("window").alias("windows"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["sum"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    per_doc = common.settled(gathered.select("doc_id", "_key", "n_words", "hits", covered.alias("n_hit"), "windows"))
    named = (
        per_doc.select("doc_id", "_key", F.explode("windows").alias("window"))
        .join(owners, "window").select("doc_id", "_key", "item").distinct()
        .groupBy("doc_id", "_key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    return common.join_rows(per_doc, named, "left").select(
        "doc_id", "_key", "n_words", "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "hits",
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = common.table(spark, folder, "documents"), common.table(spark, folder, "benchmark")
    found = contamination(docs, benchmark)
    rows = docs.select("doc_id", common.content_key().alias("_key"))
    return common.join_rows(rows, found, "inner").select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that are not contaminated."""
    found = contamination(docs, common.table(spark, folder, "benchmark"))
    return common.keep_rows(docs, found.filter(~contaminated()))
