"""Whole-second arithmetic on event timestamps (TIMESTAMP_NTZ or TIMESTAMP)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_seconds(ts: str | Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(ts.cast("timestamp"))


def time_bucket(ts: str | Column, width_seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(width_seconds)).cast("bigint")


def on_day(ts: str, day: str) -> Column:
    """Day filter that the Parquet scan sees as a pushed-down range."""
    return F.col(ts).cast("date") == F.lit(day).cast("date")
