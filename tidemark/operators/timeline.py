"""Carry values along a per-key timeline without a huge key in one task.

A window over a whole key would put all its rows into one task. Each key's
timeline is therefore cut into time buckets, at every size: rows are compared
inside (key, bucket), and what crosses a bucket border comes from a summary with
one row per (key, bucket). The per-key window runs over that summary only, whose
size is bounded by the calendar and not by the number of events.

Rows without key or time have no place on a timeline; callers set them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BUCKET_SECONDS = 300


def carry_in(
    df: DataFrame, key: list[str], bucket: str, order: list[str], columns: list[str]
) -> DataFrame:
    """Per (key, bucket): each column's last non-NULL value in earlier buckets."""
    latest = df.groupBy(*key, bucket).agg(
        *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(*order, c))).alias(c)
            for c in columns
        ]
    )
    earlier = (
        Window.partitionBy(*key)
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return latest.select(
        *key,
        bucket,
        *[
            F.last(F.col(c), ignorenulls=True).over(earlier)[c].alias(f"_in_{c}")
            for c in columns
        ],
    )


def next_start(df: DataFrame, key: list[str], bucket: str, ts: str) -> DataFrame:
    """Per (key, bucket): the first timestamp of the key's next non-empty bucket."""
    first = df.groupBy(*key, bucket).agg(F.min(ts).alias("_first"))
    return first.select(
        *key,
        bucket,
        F.lead("_first").over(Window.partitionBy(*key).orderBy(bucket)).alias("_next_start"),
    )
