"""Staging area: ``topic/dt=YYYY-MM-DD/hr=HH/landed_by=WRITER`` Parquet.

The innermost folder names who wrote it: one batch of a stream, or the backfill. Each
writer replaces its own folders only, so streams and backfills share a topic, and a
batch that is tried again leaves its rows once. An event that both bring is there
twice, as after any redelivery; the fact jobs drop copies.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from .schemas import staging_schema

WRITER = "landed_by"
BACKFILL = "backfill"


def with_partitions(events: DataFrame, timestamp_column: str = "timestamp") -> DataFrame:
    """Partition columns from event time, so that a day of staging is a day of events."""
    ts = F.col(timestamp_column)
    return events.withColumns({"dt": F.to_date(ts), "hr": F.hour(ts)})


def read_days(
    spark: SparkSession, root: str, topic: str, first: str, last: str | None = None
) -> DataFrame:
    """The topic's events of one day or a span of days; other partitions are pruned."""
    day = F.col("dt")
    return (
        spark.read.schema(staging_schema(topic))
        .parquet(f"{root}/{topic}")
        .where(day.between(F.lit(first).cast("date"), F.lit(last or first).cast("date")))
        .drop(WRITER)
    )


def read_arrived(spark: SparkSession, root: str, topic: str, since_micros: int) -> DataFrame:
    """Events of any day that were landed after a time (microseconds since 1970).

    Files that were last written before it are left out when folders are listed; rows of
    later files are judged by their ingestion time.
    """
    since = datetime.datetime.fromtimestamp(since_micros // 1_000_000, datetime.timezone.utc)
    return (
        spark.read.schema(staging_schema(topic))
        .option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
        .option("timeZone", "UTC")
        .parquet(f"{root}/{topic}")
        .where(F.unix_micros("_ingested_at") >= since_micros)
        .drop(WRITER)
    )


def write_days(events: DataFrame, root: str, topic: str, writer: str = BACKFILL) -> None:
    """Batch landing: replaces what ``writer`` wrote to the hours that ``events`` has.

    By default that is the backfill; rows that streams landed stay.
    """
    (
        events.withColumn(WRITER, F.lit(writer))
        .hint("rebalance", "dt", "hr")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "hr", WRITER)
        .parquet(f"{root}/{topic}")
    )
