"""Quality rules whose cutoffs carry a guarantee against false rejection.

Each rule rejects a document when a percentage of it exceeds a cutoff. Labelled documents are the
holdout: for a cutoff, the number of good documents it rejects is compared with the binomial
distribution at the allowed rate, and the cutoff is admitted when the exact lower tail is at most
delta / (strata x rules). Cutoffs of one rule are tested from the most lenient to the strictest and
the first failure ends the rule (fixed-sequence testing), so with probability 1 - delta no admitted
cutoff of any rule in any stratum rejects more than the allowed share of good documents. Among the
admitted ones the cutoff with the best balance of bad and good rejections is used; a stratum with too
few labels admits none and rejects nothing beyond the base rules.

Defined results: a null or empty text has no words and fails the base; a null language is a stratum
of its own; a document with several labels is good when all are; equal rows get equal verdicts; an
empty table gives no rows. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotlake.llm import common

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT = 30  # percent of words in repeated windows

# Numerator and denominator of each rule's percentage.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "stutter": ("n_stutter", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter", "n_capitals")

RATE = 0.01  # good documents one rule may reject in a stratum
DELTA = 0.05  # chance that any admitted cutoff breaks its promise
GOOD_COST = 10  # a wrongly rejected good document weighs as much as so many bad ones
BROADCAST_ROWS = 10_000  # strata whose cutoffs are sent to every executor


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, _key and the counts in STATS."""
    base = docs.select(
        "doc_id", "lang", common.content_key().alias("_key"), common.whole().alias("body"),
    ).select("*", common.words(F.col("body")).alias("words"))
    lines = F.filter(F.split("body", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = base.select(
        "doc_id", "lang", "_key", "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace("body", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("codes"),
    )
    windows = F.when(
        F.size("codes") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("codes") - WINDOW),
            lambda i: F.xxhash64(*[F.get("codes", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = counted.select(
        *[c for c in counted.columns if c not in ("lines", "words")],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    repeating = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.when(
        repeating, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    stutter = F.size(
        F.filter(F.transform("codes", lambda c, i: c.eqNullSafe(F.get("codes", i - 1))), lambda same: same)
    )
    placed = hashed.select(
        *[c for c in hashed.columns if c not in ("codes", "windows")],
        stutter.cast("long").alias("n_stutter"),
        ordered.alias("ordered"),
    )
    twice = F.filter(
        "ordered",
        lambda s, k: s["h"].eqNullSafe(F.get("ordered", k - 1)["h"]) | s["h"].eqNullSafe(F.get("ordered", k + 1)["h"]),
    )
    starts = placed.select(
        *[c for c in placed.columns if c != "ordered"],
        F.sort_array(F.transform(twice, lambda s: s["i"])).alias("starts"),
    )
    # A window covers its words up to where the next repeated window starts.
    covered = F.transform(
        "starts", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - p, F.lit(WINDOW)))
    )
    return starts.select("doc_id", "lang", "_key", *[c for c in STATS if c in starts.columns],
                         _total(covered).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def percent(rule: str) -> Column:
    top, bottom = RULES[rule]
    share = F.floor(100 * F.col(top) / F.col(bottom))
    return F.when(F.col(bottom) > 0, F.least(share, F.lit(100))).otherwise(F.lit(0)).cast("int")


def lower_tail(rejected: Column, good: Column, rate: float) -> Column:
    """P(X <= rejected), X binomial(good, rate), summed exactly. At or above the rate it is taken as 1."""
    first = good * F.ln(F.lit(1.0 - rate))
    odds = F.ln(F.lit(rate / (1.0 - rate)))
    start = F.struct(first.cast("double").alias("log"), F.exp(first).alias("sum"))

    def add(state, i):
        log = state["log"] + F.ln((good - i + 1) / i) + odds
        return F.struct(log.alias("log"), (state["sum"] + F.exp(log)).alias("sum"))

    steps = F.when(rejected > 0, F.sequence(F.lit(1).cast("long"), rejected)).otherwise(F.array().cast("array<bigint>"))
    return F.when(rejected >= good * rate, F.lit(1.0)).otherwise(F.aggregate(steps, start, add, lambda s: s["sum"]))


def cutoffs(stats: DataFrame, labels: DataFrame, rate: float = RATE, delta: float = DELTA) -> DataFrame:
    """stratum, rule, cutoff (percent above which the rule rejects) and its evidence.

    The binomial sum has at most rate x good steps; there is one for each stratum, rule and percent.
    """
    truth = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = stats.filter(~base_failed()).join(truth, "doc_id")
    # A rule that rejects none of n good documents needs about ln(1/delta)/rate of them at least.
    per_value = known.select(
        "lang", "quality",
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), percent(r).alias("pct")) for r in RULES])).alias("x"),
    ).groupBy("lang", "x.rule", "x.pct").agg(
        F.sum((F.col("quality") == 1).cast("long")).alias("good"),
        F.sum((F.col("quality") == 0).cast("long")).alias("bad"),
    )
    spread = per_value.groupBy("lang", "rule").agg(
        F.sum("good").alias("all_good"),
        F.map_from_entries(F.collect_list(F.struct("pct", F.struct("good", "bad")))).alias("at"),
    ).select("*", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).alias("tests"))

    def beyond(cut, kind):
        return F.aggregate(
            F.filter(F.map_entries("at"), lambda e: e["key"] > cut),
            F.lit(0).cast("long"), lambda a, e: a + e["value"][kind],
        )

    tried = spread.select(
        "lang", "rule", "all_good", "at", "tests", F.explode(F.sequence(F.lit(99), F.lit(0))).alias("cutoff")
    ).select("lang", "rule", "all_good", "tests", "cutoff",
             beyond(F.col("cutoff"), "good").alias("good_rejected"), beyond(F.col("cutoff"), "bad").alias("bad_rejected"))
    tail = lower_tail(F.col("good_rejected"), F.col("all_good"), rate)
    sequence = Window.partitionBy("lang", "rule").orderBy(F.desc("cutoff"))
    admitted = tried.select("*", tail.alias("tail")).select(
        "*", F.max("tail").over(sequence.rowsBetween(Window.unboundedPreceding, 0)).alias("worst")
    ).filter(F.col("worst") <= delta / F.col("tests"))
    gain = F.col("bad_rejected") - GOOD_COST * F.col("good_rejected")
    return admitted.groupBy("lang", "rule").agg(
        F.max_by(F.struct("cutoff", "good_rejected", "bad_rejected", "all_good", "tail"),
                 F.struct(gain, F.col("cutoff"))).alias("best")
    ).select("lang", "rule", "best.*")


def judged(stats: DataFrame, chosen: DataFrame) -> DataFrame:
    """stats with base_failed, rejected_by (rules, in order) and kept."""
    chosen = common.settled(
        chosen.groupBy(F.col("lang").alias("stratum"))
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    )
    if chosen.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    joined = stats.join(chosen, stats["lang"].eqNullSafe(chosen["stratum"]), "left")
    broken = F.array_compact(
        F.array(*[F.when(percent(r) > F.col("limits")[r], F.lit(r)) for r in RULES])
    )
    failed = base_failed()
    return joined.select(
        *stats.columns, failed.alias("base_failed"), broken.alias("rejected_by"),
        (~failed & (F.size(broken) == 0)).alias("kept"),
    )


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, _key, STATS, base_failed, rejected_by, kept."""
    stats = common.settled(statistics(docs))
    return judged(stats, cutoffs(stats, labels))


def query(spark: SparkSession, folder: str) -> DataFrame:
    result = judge(common.table(spark, folder, "documents"), common.table(spark, folder, "labels"))
    return result.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("rejected_by", ",").alias("rejected_by"),
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that pass."""
    result = judge(docs, common.table(spark, folder, "labels"))
    return common.keep_rows(docs, result.filter("kept"))
