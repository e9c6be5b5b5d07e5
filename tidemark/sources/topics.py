"""JSON events of a topic: decode, flatten, and where they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import ENVELOPE, ENVELOPE_FIELDS, topic_schema


def read_topic(
    spark: SparkSession, topic: str, servers: str, max_offsets: int = 1_000_000
) -> DataFrame:
    """Unbounded stream of the topic's records; needs the Kafka connector package."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Backfill input: one JSON envelope per line, as a ``value`` column.

    Reads lines as text so that backfill and stream share one decoder.
    """
    return spark.read.text(path).select("value")


def _field(name: str, data_type) -> Column:
    """A payload key wins over an envelope field of the same name."""
    inside = F.try_element_at(F.col("event.payload"), F.lit(name))
    if name in ENVELOPE_FIELDS:
        clash = F.coalesce(F.map_contains_key("event.payload", name), F.lit(False))
        inside = F.when(clash, inside).otherwise(F.col(f"event.{name}"))
    if data_type.simpleString() == "timestamp_ntz":
        # Offsets in the text are honoured; the result is UTC wall-clock time.
        return inside.try_cast("timestamp").cast("timestamp_ntz").alias(name)
    return inside.try_cast(data_type).alias(name)


def decode(records: DataFrame) -> DataFrame:
    """Parse ``value``; records that are no JSON envelope get ``is_bad``."""
    parsed = records.withColumn("event", F.from_json("value", ENVELOPE))
    return parsed.withColumn(
        "is_bad", F.col("event").isNull() | F.col("event.event_id").isNull()
    )


def flatten(decoded: DataFrame, topic: str) -> DataFrame:
    """Envelope and payload side by side, typed by the topic's schema.

    Nested payload values stay JSON text; a value that does not fit its column's
    type becomes NULL, where the quality rules see it.
    """
    return decoded.where(~F.col("is_bad")).select(
        *[_field(f.name, f.dataType) for f in topic_schema(topic).fields]
    )


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where("is_bad").select("value")


def to_records(events: DataFrame, timestamp_column: str = "event_timestamp") -> DataFrame:
    """The inverse of decode and flatten: one JSON envelope per row in ``value``."""
    envelope = ("event_id", "event_type", "user_id", timestamp_column)
    payload = [c for c in events.columns if c not in envelope]
    stamp = F.date_format(timestamp_column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return events.select(
        F.to_json(
            F.struct(
                "event_id",
                "event_type",
                F.concat(stamp, F.lit("+00:00")).alias("timestamp"),
                "user_id",
                F.struct(*payload).alias("payload"),
            )
        ).alias("value")
    )
