"""Keyed upsert: new rows replace the target's rows of the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame | None, updates: DataFrame, key: str) -> DataFrame:
    """Target rows whose key has no update, and all updates.

    One full outer join: both sides are read once and meet by key. Updates that come from
    an aggregate by the key, and a target bucketed by it, need no further shuffle. Keys
    are unique on both sides, so no key can be hot. Both sides must have the same columns.
    """
    if target is None:
        return updates
    if sorted(target.columns) != sorted(updates.columns):
        raise ValueError(f"columns changed: {target.columns} and {updates.columns}")
    old, new = target.alias("old"), updates.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(
        *[
            F.when(F.col("new._new"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            for c in target.columns
        ]
    )
