"""A schedule that mixes sources to target weights, evenly at every length.

Each source's documents are shuffled (by a hash of doc_id) into one stream of words, which repeats and is cut
into blocks of equal length. There are as many slots as blocks make up all targets, 150 % of the words. They
get golden-ratio points; a point's place on the cumulative targets names the slot's source, and the slot's
rank within that source names the block it takes. Nothing is filled up or cut back afterwards: a source
gets what the points give it, which is its target within 2 + log2(slots) blocks, for the points spread
evenly over every interval. Only a source's last block ends where the stream has been taken `MOST` times.

A document's words are those of the blocks that lie on it. As a source's ranks leave none out, the blocks
reach from its first word to a last one, which tells the words; the slots that take a document's first
and last word are looked up by rank.

Counting, ranks and running sums are done in two levels (chunk totals, then inside the chunk), so
that a source with a third of all rows is never in one task.

Defined results: a null or empty text has size 0 and is taken 0 times; null source is a source, the
last one; equal rows are laid out side by side; an empty table gives no rows. Further columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotlake.llm import common

CYCLE = (5, 2, 1)  # weights of the sources by name, repeating
SHARE = 1.5  # the mix has this many times the words there are
MOST = 2  # times a source, and so a document, may be taken
SLOTS = 2_000_000  # blocks the whole corpus is cut into, about
GOLDEN = 0.6180339887498949
SEED = "mix"
CHUNK = 1 << 14  # slots counted together
CELLS = 1 << 10  # equal parts of the weight axis on which slots meet sources


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the shuffled position's key."""
    text = common.whole()
    return docs.select(
        "doc_id", "source", F.size(common.words(text)).cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("shuffle"),
    )


def targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: sid (rank by name), source, source_size, weight, target.

    A source is capped at `most` times its size. In the order of cap per weight the capped sources come
    first, so running sums tell the level at which each would stop. The windows see a row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    named = per_source.select("*", (F.row_number().over(by_name) - 1).alias("sid"))
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.pmod("sid", F.lit(len(cycle))) + 1).cast("int"))
    capped = named.select("*", weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    before = capped.select(
        "*",
        F.coalesce(F.sum("cap").over(order), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(order), F.lit(0)).alias("weight_before"),
        F.sum("weight").over(whole).alias("weights"),
        (F.sum("source_size").over(whole) * F.lit(share)).alias("words"),
    )
    level = (F.col("words") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before"))
    stopped = before.select("*", (F.col("cap") <= F.col("weight") * level).alias("stops"))
    rest = stopped.select(
        "*",
        (F.col("words") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(whole), F.lit(0))).alias("words_left"),
        (F.col("weights") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("weight"))).over(whole), F.lit(0))).alias("weights_left"),
    )
    return rest.select(
        "sid", "source", "source_size", "weight",
        F.when(F.col("stops"), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * F.col("words_left") / F.when(F.col("weights_left") > 0, F.col("weights_left")))
        .alias("target"),
    )


def plan(sources: DataFrame) -> tuple[DataFrame, int]:
    """sources with the whole words of their targets, and the common block length."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    return sources.withColumn("need", F.coalesce(F.floor("target"), F.lit(0)).cast("long")), max(1, total // SLOTS)


def golden(slot: Column) -> Column:
    """The point of a slot, from 0 to 1."""
    turned = (slot + 1) * F.lit(GOLDEN)
    return turned - F.floor(turned)


def schedule(spark: SparkSession, sources: DataFrame, block: int, points: Callable[[Column], Column] = golden) -> DataFrame:
    """slot, sid, rank: which source every slot of the mix takes from, and the how-manieth time."""
    edges = sources.filter("need > 0").select(
        "sid", "need", F.sum("need").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)).alias("high")
    ).select("sid", (F.col("high") - F.col("need")).alias("low"), "high")
    words = edges.agg(F.max("high")).first()[0] or 0
    number = -(-words // block)
    width = max(1, -(-words // CELLS))
    cells = edges.select("sid", "low", "high", F.explode(
        F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"))
    place = F.floor(points(F.col("id")) * words).cast("long")
    slots = spark.range(number).select(F.col("id").alias("slot"), place.alias("place")).withColumn(
        "cell", F.floor(F.col("place") / width))
    drawn = slots.join(cells, "cell").filter((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high"))).select(
        "slot", "sid", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = drawn.groupBy("sid", "chunk").count().select(
        "sid", "chunk", F.coalesce(F.sum("count").over(
            Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = drawn.select("slot", "sid", "chunk",
                          F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")).alias("nth"))
    return inside.join(counts, ["sid", "chunk"]).select("slot", "sid", (F.col("before") + F.col("nth") - 1).alias("rank"))


def laid_out(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every document with its source's row and its offset in the source's shuffled stream."""
    of = sources.select("sid", F.col("source").alias("_source"), "source_size", "target", "reach")
    placed = sizes.join(of, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source").withColumn(
        "bucket", F.substring("shuffle", 1, 3))
    totals = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("words")).select(
        F.col("sid").alias("_sid"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("words").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy("sid", "bucket").orderBy("shuffle", "size").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        totals, (F.col("sid") == F.col("_sid")) & (F.col("bucket") == F.col("_bucket"))
    ).withColumn("start", F.col("bucket_start") + F.col("before")).drop("_sid", "_bucket", "bucket_start", "before", "bucket")


def mix(docs: DataFrame, points: Callable[[Column], Column] = golden) -> tuple[DataFrame, DataFrame]:
    """The documents with the words taken from each, and the mix: slot, sid, rank, lap, start, words.

    start is the first word a slot takes of its source's stream. Documents have the slots that take their
    first and last taken word.
    """
    spark = docs.sparkSession
    sizes = common.settled(sized(docs))
    sources, block = plan(common.settled(targets(sizes)))
    sources = common.settled(sources)
    # A block that would begin where the stream has been taken MOST times is nobody's.
    ranks = schedule(spark, sources, block, points).join(
        sources.select(F.col("sid").alias("_sid"), "source_size"), F.col("sid") == F.col("_sid")).drop("_sid")
    ranks = common.settled(ranks.filter(F.col("rank") * block < MOST * F.col("source_size")))
    at = F.col("rank") * block
    slots = ranks.select(
        "slot", "sid", "rank", F.floor(at / F.col("source_size")).alias("lap"), F.pmod(at, F.col("source_size")).alias("start"),
        F.least(F.lit(block), MOST * F.col("source_size") - at).alias("words"))
    reached = slots.groupBy("sid").agg(F.sum("words").alias("reach"))
    known = sources.join(reached, "sid", "left").fillna(0, ["reach"])
    first, size = F.col("start"), F.col("size")
    laps = [F.greatest(F.least(F.col("reach") - lap * F.col("source_size") - first, size), F.lit(0)) for lap in range(MOST)]
    taken = reduce(lambda a, b: a + b, laps)
    # The last word is that of the last lap that comes to the document.
    last = F.coalesce(*[F.when(words > 0, lap * F.col("source_size") + first + words - 1) for lap, words in reversed(list(enumerate(laps)))])
    rows = laid_out(sizes, known).select(
        "doc_id", "size", "source_size", "target", "sid", taken.cast("long").alias("taken"),
        F.floor(F.when(taken > 0, first) / block).alias("rank0"), F.floor(F.when(taken > 0, last) / block).alias("rank1"))
    for k, name in enumerate(("first_slot", "last_slot")):
        found = ranks.select(F.col("sid").alias("_sid"), F.col("rank").alias("_rank"), F.col("slot").alias(name))
        rows = rows.join(found, (F.col("sid") == F.col("_sid")) & (F.col(f"rank{k}") == F.col("_rank")), "left").drop("_sid", "_rank")
    return rows.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot"), slots


def query(spark: SparkSession, folder: str) -> DataFrame:
    return mix(common.table(spark, folder, "documents"))[0]


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix(docs)[0]
