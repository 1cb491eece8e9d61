"""Ranked lexical search by exact inner products in ball trees of sparse vectors.

A document is a sparse vector over terms, an item the vector of its terms' weights; a document's score
is their inner product. Only terms of items matter: a document keeps its counts of those alone. The
documents of a task go into ball trees of bounded size: a node has a centroid and the radius of the ball that
holds its documents, and no document of it scores more than <item, centroid> + |item| * radius. Sparse
vectors are far from each other, so the radius is taken for each of `GROUPS` groups of terms (as the ball's
extent in these coordinates), and of the item only terms that the node's documents hold count: the bound
is the sum over groups. Nodes are opened in the order of these bounds; a node whose bound is below the item's
k-th best score so far is left out with all its documents. At the leaves scores are computed in 64-bit integers.

Coordinates are stretched before the trees are built (a document's by s, an item's by 1/s, term by term),
which leaves inner products alone and makes the balls tight where items look.

Bounds are in doubles and rounded to the safe side: a sum of n numbers that are not negative is off by less than
n units in the last place; radii and bounds are raised by a multiple of that. A pruned document cannot
reach the result.

Every task keeps its k best documents per item; they are merged in two steps by ranking. Items are the query
set: they are taken in blocks of about `BLOCK` terms, chosen by hash, so that what is sent to the workers does
not grow with their number. N, L and all document frequencies count the whole table.

Defined results: rows with the same item_id (null included) are one item, with the terms of all of them;
every row of the documents is a document of its own, repeated doc_ids included, null doc_ids come last among
equal scores; null and empty texts have no terms; no document or item gives no rows. Further columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotlake.llm.common import LOWER, UPPER, plain_words, settled, table, whole

BEST = 50  # documents per item
BLOCK = 200_000  # terms of items searched together
ENTRIES, DOCUMENTS = 1 << 20, 1 << 15  # of a tree, at most (but for its last document)
LEAF = 32
GROUPS = 64  # of terms, by the number of documents that hold them: a radius each
MEANS = 1  # times the sides of a split are drawn again around their means
EPS = 2.0**-52
# UTF-8 bytes as words have them: A-Z lower-cased, all else in ASCII but digits and letters a space.
WORD_BYTES = bytes(
    LOWER.encode()[UPPER.index(chr(b))] if chr(b) in UPPER else b if b > 127 or chr(b) in LOWER + "0123456789" else 32
    for b in range(256))


@dataclass
class Items:
    """A block of items: the weight of each term of the block, and each item's terms by number."""

    weight: np.ndarray
    terms: list[np.ndarray]


@dataclass
class Vectors:
    """Sparse rows: entries of row i stand from start[i] to start[i + 1]."""

    start: np.ndarray
    term: np.ndarray
    value: np.ndarray  # whole numbers

    def rows(self, chosen: np.ndarray) -> Vectors:
        size = self.start[chosen + 1] - self.start[chosen]
        start = np.append(0, np.cumsum(size))
        place = np.arange(start[-1]) + np.repeat(self.start[chosen] - start[:-1], size)
        return Vectors(start, self.term[place], self.value[place])


class BallTree:
    """Centroids and radii over the rows of sparse vectors in stretched coordinates, none of them negative."""

    def __init__(self, vectors: Vectors, weight: np.ndarray) -> None:
        count, width = len(vectors.start) - 1, len(weight)
        value = vectors.value.astype(np.float64)
        mean = np.bincount(vectors.term, value, width) / count
        away = np.sqrt(np.maximum(np.bincount(vectors.term, value * value, width) / count - mean * mean, 1.0))
        self.stretch = np.sqrt(np.maximum(weight, 1) / away)
        held = np.bincount(vectors.term, minlength=width)
        self.group = np.argsort(np.argsort(held, kind="stable"), kind="stable") * GROUPS // width
        self.low, self.high, self.left = [0], [count], [-1]
        self.order = np.arange(count)
        centres: list[tuple[np.ndarray, np.ndarray]] = []
        radii: list[np.ndarray] = []
        node = 0
        while node < len(self.low):  # children stand behind their parents
            low, high = self.low[node], self.high[node]
            part = vectors.rows(self.order[low:high])
            x = part.value * self.stretch[part.term]
            size = high - low
            centre = np.bincount(part.term, x, width) / size
            there = np.flatnonzero(centre)
            centres.append((there, centre[there]))
            radii.append(self._radii(part, x, centre, there))
            if size > LEAF:
                near = self._sides(part, x, centre, width)
                self.order[low:high] = self.order[low:high][np.argsort(near, kind="stable")]
                middle = low + min(max(int((near < 0).sum()), size // 8), size - size // 8)
                self.left[node] = len(self.low)
                self.low += [low, middle]
                self.high += [middle, high]
                self.left += [-1, -1]
            node += 1
        self.vectors = vectors.rows(self.order)
        self.radii = np.array(radii)
        # The centroids by term: which nodes have it, and how much of it.
        terms = np.concatenate([terms for terms, _ in centres])
        nodes = np.repeat(np.arange(len(centres)), [len(terms) for terms, _ in centres])
        order = np.argsort(terms, kind="stable")
        self.node, self.mass = nodes[order], np.concatenate([mass for _, mass in centres])[order]
        self.first = np.searchsorted(terms[order], np.arange(width + 1))

    def _radii(self, part: Vectors, x: np.ndarray, centre: np.ndarray, there: np.ndarray) -> np.ndarray:
        """How far the rows reach from the centroid in each group of terms, never too little."""
        rows = len(part.start) - 1
        cell = np.repeat(np.arange(rows), np.diff(part.start)) * GROUPS + self.group[part.term]
        at = centre[part.term]
        own = np.bincount(self.group[there], centre[there] ** 2, GROUPS)
        # A row's distance: its own terms, and the centroid's mass at all others.
        squares = np.bincount(cell, (x - at) ** 2, rows * GROUPS).reshape(rows, GROUPS)
        met = np.bincount(cell, at * at, rows * GROUPS).reshape(rows, GROUPS)
        spare = 8 * EPS * (len(there) + 16) * (squares + own)
        return np.sqrt((squares + np.maximum(own - met, 0.0) + spare).max(axis=0)) * (1 + 8 * EPS)

    def _sides(self, part: Vectors, x: np.ndarray, centre: np.ndarray, width: int) -> np.ndarray:
        """Below zero for rows on the first of two sides: first those of two distant rows, then those of the
        means of the rows on each."""
        norm = np.add.reduceat(x * x, part.start[:-1])

        def distance(point: np.ndarray) -> np.ndarray:
            return norm - 2 * np.add.reduceat(x * point[part.term], part.start[:-1]) + float(point @ point)

        def row(at: int) -> np.ndarray:
            low, high = part.start[at], part.start[at + 1]
            point = np.zeros(width)
            point[part.term[low:high]] = x[low:high]
            return distance(point)

        one = row(int(np.argmax(distance(centre))))
        near = one - row(int(np.argmax(one)))
        for _ in range(MEANS):
            first = near < 0
            if not first.any() or first.all():
                break
            entry = np.repeat(first, np.diff(part.start))
            near = distance(np.bincount(part.term[entry], x[entry], width) / first.sum()) - distance(
                np.bincount(part.term[~entry], x[~entry], width) / (~first).sum())
        return near

    def bounds(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """No document of a node scores more than this: per group of terms, the part of the item that meets
        terms of the node, times the radius, beside the centroid's score."""
        query, nodes = weight / self.stretch[terms], len(self.low)
        size = self.first[terms + 1] - self.first[terms]
        start = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(self.first[terms] - start, size)
        node = self.node[place]
        inner = np.bincount(node, self.mass[place] * np.repeat(query, size), nodes)
        squares = np.bincount(node * GROUPS + np.repeat(self.group[terms], size), np.repeat(query * query, size), nodes * GROUPS)
        reach = np.sqrt(squares.reshape(nodes, GROUPS))
        raised = 1 + 4 * EPS * (len(terms) + len(self.stretch) + GROUPS + 16)
        return (inner + (reach * self.radii).sum(axis=1)) * raised

    def search(self, terms: np.ndarray, weight: np.ndarray, dense: np.ndarray, keys: list, best: list, limit: int) -> None:
        """best, a heap of at most `limit` (score, key), with the documents of this tree. dense holds the
        weights at their terms; the greater of equal scores is the greater key."""
        bounds = self.bounds(terms, weight)
        queue = [(-float(bounds[0]), 0)]
        vectors = self.vectors
        while queue:
            bound, node = heapq.heappop(queue)
            least = best[0][0] if len(best) == limit else 1
            if -bound < least:
                return  # and with it all that is left
            if (left := self.left[node]) >= 0:
                for child in (left, left + 1):
                    if (above := min(-bound, float(bounds[child]))) >= least:
                        heapq.heappush(queue, (-above, child))
                continue
            low, high = self.low[node], self.high[node]
            a, b = vectors.start[low], vectors.start[high]
            scores = np.add.reduceat(dense[vectors.term[a:b]] * vectors.value[a:b], vectors.start[low:high] - a)
            for at in np.flatnonzero(scores >= least).tolist():
                entry = (int(scores[at]), keys[self.order[low + at]])
                if len(best) < limit:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def counted(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (words of the text) and its counts of the given terms, of every text that has a word."""
    shared = docs.sparkSession.sparkContext.broadcast({term.encode(): k for k, term in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            rows = []
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
                words = body.as_py().translate(WORD_BYTES).split()
                if words:
                    counts = Counter(map(number.get, words))
                    counts.pop(None, None)
                    rows.append((doc_id, len(words), list(counts), list(counts.values())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())))],
                ["doc_id", "n", "term", "tf"])

    return docs.select(F.col("doc_id").cast("long"), whole().cast("binary").alias("body")).mapInArrow(
        run, "doc_id long, n long, term array<int>, tf array<long>")


def weights(vectors: DataFrame, terms: int, total: int) -> np.ndarray:
    """The weight of each term from the number of documents that hold it."""
    held = vectors.select(F.explode("term").alias("term")).groupBy("term").count().collect()  # a row per term of the block
    out = np.zeros(terms, np.int64)
    for term, count in held:
        out[term] = math.floor(1000 * math.log((2 * total + 2) / (2 * count + 1)))
    return out


def best_of_tasks(vectors: DataFrame, items: Items, total: int, length: int, limit: int) -> DataFrame:
    """item (number), doc_id, score: the best documents per item of every task, found by its ball trees."""
    shared = vectors.sparkSession.sparkContext.broadcast(items)

    def trees(batches: Iterator[pa.RecordBatch], weight: np.ndarray):
        """Keys of documents (greater is better) with their tree."""
        kept, entries, keys = [], 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, n = batch.column("doc_id").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            term, tf = batch.column("term"), batch.column("tf").flatten().to_numpy().astype(np.int64)
            start = term.offsets.to_numpy().astype(np.int64)
            start, place = start - start[0], term.flatten().to_numpy().astype(np.int64)
            m = np.repeat(50 + (50 * n * total) // length, np.diff(start))
            value = (1_000_000_000 * tf) // (1000 * tf + 20 * m)
            row = np.repeat(np.arange(len(ids)), np.diff(start))
            useful = (weight[place] > 0) & (value > 0)
            row, place, value = row[useful], place[useful], value[useful]
            sizes = np.bincount(row, minlength=len(ids))
            edges = np.append(0, np.cumsum(sizes))
            for at in np.flatnonzero(sizes).tolist():
                a, b = edges[at], edges[at + 1]
                kept.append((place[a:b], value[a:b]))
                keys.append(-math.inf if ids[at] is None else -ids[at])
                entries += b - a
                if entries >= ENTRIES or len(kept) >= DOCUMENTS:
                    yield keys, tree_of(kept, weight)
                    kept, entries, keys = [], 0, []
        if kept:
            yield keys, tree_of(kept, weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best: list[list] = [[] for _ in own.terms]
        dense = np.zeros(len(own.weight), np.int64)
        for keys, tree in trees(batches, own.weight):
            for heap, terms in zip(best, own.terms):
                dense[terms] = own.weight[terms]
                tree.search(terms, own.weight[terms], dense, keys, heap, limit)
                dense[terms] = 0
        found = [(item, None if key == -math.inf else -key, score) for item, heap in enumerate(best) for score, key in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in found], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))],
            ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item int, doc_id long, score long")


def tree_of(rows: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray) -> BallTree:
    start = np.append(0, np.cumsum([len(term) for term, _ in rows]))
    return BallTree(Vectors(start, np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows])), weight)


def merged(found: DataFrame, tasks: int, limit: int) -> DataFrame:
    """The best of all tasks with their rank, by way of the best of groups of tasks."""
    groups = math.ceil(math.sqrt(tasks))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(groups)))
    some = some.select("item", "doc_id", "score", "_group",
                       F.row_number().over(Window.partitionBy("item", "_group").orderBy(*order)).alias("rank"))
    some = some.filter(F.col("rank") <= limit).drop("rank")
    ranked = some.select("item", "doc_id", "score", F.row_number().over(Window.partitionBy("item").orderBy(*order)).alias("rank"))
    return ranked.filter(F.col("rank") <= limit)


def search(docs: DataFrame, items: DataFrame, limit: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the `limit` best documents of every item."""
    spark = docs.sparkSession
    pairs = items.select("item_id", F.explode(plain_words(whole())).alias("term")).distinct()
    grouped = settled(pairs.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")))
    size = grouped.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-size // BLOCK)
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    total, length = 0, 0
    for block in range(blocks):
        rows = grouped.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # one block of the query set
        terms = sorted({term for row in rows for term in row["terms"]})
        vectors = settled(counted(docs, terms))
        if not block:
            total, length = vectors.agg(F.count("*"), F.sum("n")).first()
        if not total:
            return out
        number = {term: k for k, term in enumerate(terms)}
        chosen = Items(weights(vectors, len(terms), total),
                       [np.array([number[term] for term in row["terms"]], np.int64) for row in rows])
        names = spark.createDataFrame([(k, row["item_id"]) for k, row in enumerate(rows)], f"item int, item_id {kind}")
        found = best_of_tasks(vectors, chosen, total, length, limit)
        ranked = merged(found, vectors.rdd.getNumPartitions(), limit)
        ranked = ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if blocks == 1 else out.unionByName(settled(ranked))
    return out


def query(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
