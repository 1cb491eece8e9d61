"""SimHash fingerprints and their near-duplicate groups, found with pivot distance tables.

A fingerprint has 64 bits; two link at `max_bits` or fewer differing bits. Pivots are fixed reference
fingerprints, and each distinct fingerprint gets the table of its Hamming distances to them once. By the
triangle inequality a pair whose distances to any pivot differ by more than `max_bits` cannot link.

- Zero and the 64 one-bit words are pivots whose distances spell out a fingerprint's bits. Cut into
  `max_bits + 2` bands, two linked fingerprints have equal distances to the pivots of two bands at
  least, so every pair of bands is an equi-join key, and no pair outside a key's bucket can link.
- Inside a bucket pairs are discarded by the maximum coordinate difference over `PIVOTS` pseudo-random
  pivots; what survives is verified bit by bit.
- A bucket of more than `DENSE` distinct fingerprints (many near copies of one text) is not paired:
  each fingerprint meets the words within one bit of it that share the key, and links to the smallest
  fingerprint met at the same word. Those meet exactly when they are at most two bits apart, and rows
  grow with the bucket, not with its square. With another `max_bits` all buckets are paired.

Equal fingerprints are one row from the start, so copies never multiply pairs. Components follow from the
links by contraction: every node joins the smallest neighbour, until no link is left.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked like
any other; equal rows share a component; a component of rows whose doc_ids are all null has a null id;
an empty table gives no rows. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm import common

SHINGLE = 3  # words
MAX_BITS = 2
SEED = 42
PIVOTS = 16
DENSE = 64  # distinct fingerprints in a bucket beyond which they are linked by way of shared words

_LANES = np.uint64(0x0101010101010101)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


# Reference fingerprints by a fixed rule: the hashes of 0, 1, 2, ...
PIVOT_WORDS = [_signed(xxhash.xxh64_intdigest(k.to_bytes(4, "little"), SEED)) for k in range(PIVOTS)]


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every run of `size` words, repeats included; of all words where there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    runs = map(b" ".join, zip(*(words[k:] for k in range(size))))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, len(words) - size + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; zero for none.

    Eight bits at a time are counted in the bytes of 64-bit words, in blocks whose counts fit a byte.
    """
    counts = np.zeros((8, 8), np.int64)  # [shift, byte]
    blocks = np.arange(0, len(hashes), 255)
    for shift in range(8) if len(hashes) else ():
        lanes = (hashes >> np.uint64(shift)) & _LANES
        sums = np.add.reduceat(lanes, blocks)
        counts[shift] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    over = 2 * counts > len(hashes)
    return sum(1 << (8 * byte + shift) for byte in range(8) for shift in range(8) if over[shift, byte])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, _key, fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("body").cast(pa.binary())
            found = [_signed(majority(shingle_hashes(t.as_py(), size))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_key"), pa.array(found, pa.int64())], ["doc_id", "_key", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), common.content_key().alias("_key"), common.whole().alias("body"))
    return rows.mapInArrow(run, "doc_id long, _key long, fp long")


def _bands(max_bits: int) -> list[int]:
    """Masks of max_bits + 2 bands that cover the 64 bits."""
    number = max_bits + 2
    edges = [64 * k // number for k in range(number + 1)]
    return [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]


def _coordinates(fp: Column) -> list[Column]:
    """Distances to the pseudo-random pivots, eight to a long."""
    packed = []
    for low in range(0, PIVOTS, 8):
        value = F.lit(0).cast("long")
        for k, word in enumerate(PIVOT_WORDS[low:low + 8]):
            distance = F.bit_count(fp.bitwiseXOR(F.lit(word))).cast("long")
            value = value.bitwiseOR(F.shiftleft(distance, 8 * k) if k else distance)
        packed.append(value.alias(f"d{low // 8}"))
    return packed


def _apart(left: Column, right: Column, k: int) -> Column:
    return F.abs(F.shiftright(left, 8 * k).bitwiseAND(F.lit(255)) - F.shiftright(right, 8 * k).bitwiseAND(F.lit(255)))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: enough pairs of distinct fingerprints within max_bits to connect all that are. prints: fp, distinct."""
    masks = _bands(max_bits)
    choices = [masks[i] | masks[j] for i, j in combinations(range(len(masks)), 2)]
    keys = F.array(*[
        F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("bits"))
        for n, mask in enumerate(choices)
    ])
    keyed = prints.select("fp", *_coordinates(F.col("fp")), F.explode(keys).alias("k")).select(
        "fp", "d0", "d1", "k.choice", "k.bits")
    sizes = keyed.groupBy("choice", "bits").count().filter("count > 1")
    shared = common.settled(keyed.join(sizes, ["choice", "bits"]))
    dense = (F.col("count") > DENSE) if max_bits == 2 else F.lit(False)
    sparse = shared.filter(~dense).drop("count")
    other = sparse.select("choice", "bits", F.col("fp").alias("b"), F.col("d0").alias("e0"), F.col("d1").alias("e1"))
    near = F.lit(True)
    for n in range(PIVOTS // 8):
        for k in range(8):
            near = near & (_apart(F.col(f"d{n}"), F.col(f"e{n}"), k) <= max_bits)
    pairs = sparse.join(other, ["choice", "bits"]).filter(
        (F.col("fp") < F.col("b")) & near & (F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= max_bits)
    ).select(F.col("fp").alias("a"), "b")
    # Words within one bit of a fingerprint, changed only where the bucket leaves bits free.
    free = F.element_at(F.array(*[
        F.array(*[F.lit(_signed(1 << k)) for k in range(64) if not mask >> k & 1]) for mask in choices
    ]), F.col("choice") + 1)
    met = shared.filter(dense).select(
        "choice", "fp", F.explode(F.concat(F.array("fp"), F.transform(free, lambda bit: F.col("fp").bitwiseXOR(bit)))).alias("word"))
    hubs = met.groupBy("choice", "word").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = met.join(hubs.drop("n"), ["choice", "word"]).filter(F.col("fp") != F.col("hub")).select(
        F.col("hub").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b); nodes of a component share the root.

    Nodes must be spread like random words, as fingerprints are: then each round leaves a fraction of them.
    """
    edges = common.settled(edges.filter("a != b"))
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        step = common.settled(
            both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("root")))
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("y"))
        edges = common.settled(
            edges.join(left, "a").join(right, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .filter("a != b").distinct())
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    result = maps.pop()
    while maps:
        later = result.select(F.col("node").alias("root"), F.col("root").alias("later"))
        result = maps.pop().join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return result


def grouped(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, _key, fp and component_id (smallest doc_id of the component) of every row."""
    marked = common.settled(fingerprints(docs, size))
    prints = common.settled(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = common.settled(components(links(prints.select("fp"), max_bits)))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    per_print = rooted.select("fp", "root").join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(per_print, F.col("fp") == F.col("_fp")).drop("_fp")


def query(spark: SparkSession, folder: str) -> DataFrame:
    result = grouped(common.table(spark, folder, "documents"))
    return result.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, once if its row repeats.

    Of a component whose doc_ids are all null, one row of each fingerprint stays.
    """
    result = grouped(docs)
    kept = common.settled(result).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = kept.groupBy("fp", "doc_id").agg(F.min("_key").alias("_key"))
    rows = common.keep_rows(docs, first)
    # Repeated rows are rare and cost a shuffle of the texts, so it is spared where there are none.
    if kept.groupBy("doc_id", "_key").count().filter("count > 1").isEmpty():
        return rows
    return rows.dropDuplicates([c for c in ("doc_id", "text", "lang", "source") if c in docs.columns])
