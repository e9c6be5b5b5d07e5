"""Structured Streaming: land topics, drop redeliveries, build sessions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.staging import WRITER, with_partitions, write_days
from ..sources.topics import dead_letters, decode, flatten


def land_topic(
    records: DataFrame,
    topic: str,
    root: str,
    checkpoint: str,
    every: str | None = "60 seconds",
) -> StreamingQuery:
    """Start a query: events to ``root/topic/dt=/hr=``, bad records aside.

    The source is read once per batch. A batch owns the folders that are named by the
    query's id (kept in the checkpoint) and its number, and replaces them if it is
    tried again, so a restart neither loses nor repeats rows. ``every=None`` handles
    what is available and stops.
    """

    def land(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        writer = f"{query}-{number}"
        decoded = decode(batch.persist())
        events = with_partitions(flatten(decoded, topic))
        write_days(events.withColumn("_ingested_at", F.current_timestamp()), root, topic, writer)
        (
            dead_letters(decoded)
            .withColumn(WRITER, F.lit(writer))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(WRITER)
            .text(f"{root}/_dead_letters/{topic}")
        )
        batch.unpersist()

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        records.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{checkpoint}/{topic}")
        .trigger(**trigger)
        .start()
    )


def first_in_task(events: DataFrame, id_column: str = "event_id") -> DataFrame:
    """One row per id of what a task reads of a micro-batch, the first; needs no state.

    A task remembers the ids of its share of the batch. What goes on to a shuffle is at most
    ids times tasks, however many copies one id has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            keep = []
            for at, id in enumerate(batch.column(id_column).to_pylist()):
                if id not in seen:
                    seen.add(id)
                    keep.append(at)
            yield batch if len(keep) == batch.num_rows else batch.take(pa.array(keep, pa.int64()))

    return events.mapInArrow(run, events.schema)


def drop_redeliveries(
    events: DataFrame,
    timestamp_column: str,
    id_column: str = "event_id",
    horizon: str = "1 hour",
) -> DataFrame:
    """First arrival of each id; ids are remembered for ``horizon`` of event time.

    Copies within a task's share of a micro-batch go ahead of the state store, so that an id
    delivered very often doesn't fill one of its partitions.
    """
    return (
        first_in_task(events, id_column)
        .withColumn("_event_time", F.col(timestamp_column).cast("timestamp"))
        .withWatermark("_event_time", horizon)
        .dropDuplicatesWithinWatermark([id_column])
        .drop("_event_time")
    )


def stream_sessions(
    events: DataFrame,
    timestamp_column: str,
    user_column: str = "user_id",
    gap_minutes: int = 30,
    lateness: str = "1 hour",
) -> DataFrame:
    """Sessions, emitted once the watermark has passed their end plus the gap.

    The state store merges sessions incrementally: per user it holds open
    sessions (start, end, count), not events.
    """
    span = F.session_window("_event_time", f"{gap_minutes} minutes")
    return (
        events.withColumn("_event_time", F.col(timestamp_column).cast("timestamp"))
        .withWatermark("_event_time", lateness)
        .groupBy(user_column, span)
        .agg(F.count("*").alias("event_count"))
        .select(
            user_column,
            F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
            F.col("session_window.end").cast("timestamp_ntz").alias("session_closes"),
            "event_count",
        )
    )


def run_to_end(frame: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available into Parquet at ``path`` (append mode), then stop."""
    (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
