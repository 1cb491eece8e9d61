"""Places in an order over all rows, without bringing the rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settled


def with_rank(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with their place (from 1) in the order, which must tell all rows apart.

    Rows are dealt out by ranges of the order and sorted there; a row's place is its place in its
    range plus the rows of the ranges before, one row each. The ranges are drawn from a sample, so
    the dealt rows are written once and everything after reads those.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settled(rows.repartitionByRange(partitions, *order).withColumn("_range", F.spark_partition_id()))
    before = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_range",
        F.coalesce(
            F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        dealt.withColumn("_place", place)
        .join(F.broadcast(before), "_range")
        .withColumn(name, (F.col("_before") + F.col("_place")).cast("int"))
        .drop("_range", "_place", "_before")
    )
