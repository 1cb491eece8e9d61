"""Whitening of embeddings with distributed block matrices.

Entries become whole numbers x = floor(scale * c). The covariance is taken over the distinct x-vectors, so
that a vector that many rows share counts once. Their centred rows are indexed into the blocks of a
`BlockMatrix`; its transpose times itself, with the rows split over tasks and the products summed, is the
scatter. The scatter has as many rows and columns as a vector has entries (`WIDEST` at most), whatever the
number of rows: it alone comes to the driver, for its eigenvectors. The rows are projected by one more
BlockMatrix product, with the whitening matrix.

Blocks are dealt by row number, so no vector, however frequent, is a key of a join or of a large group.

Defined results: rows whose vector is null or holds a null or non-finite entry are left out; vectors that
are shorter than the longest count as filled up with zeros; rows are kept as often as they come, a null
vec_id stays null; components without variance (an eigenvalue of at most 1e-12 of the trace) cannot be
scaled and have no rows, so that a table of one distinct vector, or an empty one, gives no rows; vectors of
more than `WIDEST` entries are refused. Numbers that leave the range of a long fail the job, as everywhere
in Spark. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm.common import settled, table

SCALE = 256
COMPONENTS = 4
WIDEST = 8192  # entries of a vector: the scatter is held by the driver
BLOCK_ROWS, BLOCK_COLUMNS = 4096, 1024
FLAT = 1e-12  # of the trace: an eigenvalue that counts as none
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


@dataclass
class Fit:
    """What the fit list says: its length, sums per dimension, eigenvalues (falling) and whitening matrix."""

    n: int
    sums: list[int]
    explained: list[float]
    matrix: np.ndarray  # dimensions x components
    identity_error: float


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """_id and x (array of long) of the rows whose vector is whole."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    entries = F.transform(vector, lambda c: c.cast("double"))
    return rows.select(F.col(key).cast("long").alias("_id"), entries.alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.exists("_v", bad)
    ).select("_id", F.transform("_v", lambda c: F.floor(c * scale)).alias("x"))


def numbered(df: DataFrame) -> DataFrame:
    """df, settled, with row numbers 0, 1, 2, ... in `_row`.

    The partitions of a settled table stay as they are, so a row's number is its place in its partition
    behind the sizes of the partitions before: a row per partition goes through the driver.
    """
    marked = settled(df).select("*", F.monotonically_increasing_id().alias("_mark"))
    part = F.shiftright("_mark", 33).cast("int")
    sizes = sorted(map(tuple, marked.groupBy(part).count().collect()))
    starts, before = [], 0
    for number, size in sizes:
        starts.append((number, before - (number << 33)))
        before += size
    firsts = df.sparkSession.createDataFrame(starts or [(0, 0)], "_part int, _shift long")
    return marked.withColumn("_part", part).join(F.broadcast(firsts), "_part").withColumn(
        "_row", F.col("_mark") + F.col("_shift")).drop("_mark", "_part", "_shift")


def centred(x: Column, n: int, sums: list[int]) -> Column:
    """n * x - S, exact."""
    return F.zip_with(x, F.lit(sums), lambda a, s: a * F.lit(n).cast("long") - s)


def blocks(rows: DataFrame, count: int, n: int, sums: list[int]) -> BlockMatrix:
    """The centred rows, indexed into distributed blocks."""
    values = F.transform(centred(F.col("x"), n, sums), lambda c: c.cast("double") / n)
    vectors = MLUtils.convertVectorColumnsFromML(
        rows.select(F.col("_row").alias("index"), array_to_vector(values).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, count, len(sums)).toBlockMatrix(BLOCK_ROWS, BLOCK_COLUMNS)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times matrix. The middle dimension is split, so that its blocks meet in many tasks and
    only products of the size of the result are summed."""
    turned = matrix.transpose()
    splits = max(1, min(matrix.blocks.getNumPartitions(), -(-matrix.numRows() // BLOCK_ROWS)))
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, BLOCK_COLUMNS, BLOCK_COLUMNS).toLocalMatrix().toArray()


def project(matrix: BlockMatrix, directions: np.ndarray) -> DataFrame:
    """_row and y (array of double): the rows times the directions."""
    spark = SparkSession.getActiveSession()
    tall, wide = directions.shape
    parts = [((k, 0), Matrices.dense(len(part), wide, part.ravel(order="F")))
             for k, part in enumerate(np.split(directions, range(BLOCK_COLUMNS, tall, BLOCK_COLUMNS)))]
    right = BlockMatrix(spark.sparkContext.parallelize(parts, 1), BLOCK_COLUMNS, wide, tall, wide)
    rows = matrix.multiply(right).toIndexedRowMatrix().rows
    return spark.createDataFrame(rows.map(lambda r: (r.index, r.vector.toArray().tolist())), "_row long, y array<double>")


def spread(projected: DataFrame, size: int, n: int) -> np.ndarray:
    """The covariance of y, centred before multiplying."""
    y = [F.col("y")[k] for k in range(size)]
    means = projected.agg(*[F.avg(c) for c in y]).first()
    away = [c - F.lit(mean) for c, mean in zip(y, means)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = projected.agg(*[F.sum(away[i] * away[j]) for i, j in pairs]).first()
    out = np.zeros((size, size))
    for (i, j), value in zip(pairs, sums):
        out[i, j] = out[j, i] = value / n
    return out


def learn(rows: DataFrame, width: int, components: int = COMPONENTS) -> Fit | None:
    """Fitted on the distinct x of rows, each of the given width."""
    fit = numbered(rows.select("x").distinct())
    n = fit.count()
    totals = dict(map(tuple, fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum("c")).collect()))
    sums = [totals[k] for k in range(width)]
    matrix = blocks(fit, n, n, sums)
    values, vectors = np.linalg.eigh(scatter(matrix) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(values.sum())
    kept = int(sum(values[:components] > max(trace, 0.0) * FLAT))
    if not kept:
        return None
    whitener = vectors[:, :kept] / np.sqrt(values[:kept])
    error = np.abs(spread(project(matrix, whitener), kept, n) - np.eye(kept)).max()
    return Fit(n, sums, [float(v) / trace for v in values[:kept]], whitener, float(error))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per whole vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    whole = numbered(whole_vectors(rows, key, vector))
    count, width, narrow = whole.agg(F.count("*"), F.max(F.size("x")), F.min(F.size("x"))).first()
    if not width:
        return spark.createDataFrame([], RESULT)
    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries; at most {WIDEST} can be whitened")
    if narrow < width:
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
        whole = whole.withColumn("x", F.concat("x", zeros))
    fit = learn(whole, width, components)
    if fit is None:
        return spark.createDataFrame([], RESULT)
    away = F.aggregate(centred(F.col("x"), fit.n, fit.sums), F.lit(0).cast("long"), lambda total, c: total + c * c)
    projected = project(blocks(whole, count, fit.n, fit.sums), fit.matrix)
    wide = whole.select("_row", "_id", away.alias("deviation")).join(projected, "_row")
    return wide.select("_id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        F.col("_id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"),
        "deviation", "whitened", F.element_at(F.lit(fit.explained), F.col("at") + 1).alias("explained"),
        F.lit(fit.identity_error).alias("identity_error"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))
