"""Moments in and out of Spark, whatever the driver machine's time zone."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def timestamp_literal(moment: datetime) -> Column:
    """A moment as a timestamp; without a zone it is read in the session's."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def latest_moment(df: DataFrame, column: str) -> datetime | None:
    """The latest timestamp of a column as a Python moment in UTC."""
    micros = df.agg(F.max(F.unix_micros(column)).alias("latest")).first().latest
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return None if micros is None else start + timedelta(microseconds=micros)
