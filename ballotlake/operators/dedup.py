"""Removing repeats without ever sending one group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unseen_records(
    new: DataFrame,
    existing: DataFrame | None,
    key: str = "record_hash",
    file_order: str | None = None,
) -> DataFrame:
    """New rows whose key is not among the existing rows' keys.

    With ``file_order`` the new rows count as loaded file after file in that order: a key
    also met in an earlier file is dropped. Repeats inside one file always stay.

    Keys are first reduced to one row each (partial aggregation, so a key holding a third of all
    rows costs one row per task). The stored keys are only looked up: they are filtered by the few
    new ones, which moves them not at all when those are few enough to be sent to every task or the
    stored table is bucketed by the key. The kept keys are unique in the last join, so a
    frequent key's rows can be split over tasks. Null keys are new.
    """
    tagged = new.withColumn("_at", F.col(file_order) if file_order else F.lit(0))
    firsts = tagged.groupBy(key).agg(F.min("_at").alias("_first"))
    if existing is not None:
        seen = existing.select(key).join(firsts.select(key), key, "left_semi").distinct()
        firsts = firsts.join(seen, key, "left_anti")
    firsts = firsts.select(F.col(key).alias("_key"), "_first")
    placed = tagged.join(firsts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_first")))
    return placed.select(*new.columns)


def single_version(rows: DataFrame, key: str) -> DataFrame:
    """Rows of the keys that have exactly one distinct version; null keys are dropped.

    A key's versions agree exactly when its least and greatest row are the same, which
    needs one shuffle with partial aggregation, no distinct and no per-key window.
    """
    fields = [c for c in rows.columns if c != key]
    version = F.struct(*fields)
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(version).alias("_least"), F.max(version).alias("_greatest"))
        .where(F.col("_least").eqNullSafe(F.col("_greatest")))
        .select(key, "_least.*")
        .select(*rows.columns)
    )


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order; null keys are equal to each other.

    ``order`` must tell all rows of a key apart. An aggregate rather than a window, so
    that every task keeps one row per key.
    """
    fields = F.struct(*[c for c in rows.columns if c not in keys])
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(fields, F.struct(*order)).alias("_first"))
        .select(*keys, "_first.*")
        .select(*rows.columns)
    )
