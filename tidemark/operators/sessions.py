"""Sessions by inactivity gap.

With buckets no wider than the gap, two events of a user in one bucket always
share a session. The session number is thus a function of (user, bucket): events
are pre-aggregated to one row per (user, bucket) ahead of the shuffle, numbered
there, and the number is joined back. No user's raw events meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.timestamps import epoch_seconds, time_bucket

DAY = 86_400


def _bucket_seconds(gap_minutes: int) -> int:
    return max(gap_minutes * 60, 1)


def session_id(user: str, number: str | Column) -> Column:
    """The number is padded to six digits; longer ones are kept whole."""
    text = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(F.col(user), F.lit("_sess_"), F.lpad(text, F.greatest(F.length(text), F.lit(6)), F.lit("0")))


def _numbered(
    df: DataFrame, user: str, ts: str, gap_minutes: int, carry: DataFrame | None = None
) -> DataFrame:
    """One row per (user, bucket) with its session number and span.

    ``carry`` (user, last_seen, last_session) continues the numbering of earlier
    data: its rows act as one more, already numbered event ahead of the others.
    """
    spans = (
        df.where(F.col(ts).isNotNull())
        .groupBy(user, time_bucket(ts, _bucket_seconds(gap_minutes)).alias("_bucket"))
        .agg(
            F.min(ts).alias("_start"),
            F.max(ts).alias("_end"),
            F.count("*").alias("_events"),
        )
    )
    base = F.lit(None).cast("bigint")
    spans = spans.withColumn("_base", base)
    if carry is not None:
        spans = spans.unionByName(
            carry.select(
                user,
                time_bucket("last_seen", _bucket_seconds(gap_minutes)).alias("_bucket"),
                F.col("last_seen").alias("_start"),
                F.col("last_seen").alias("_end"),
                F.lit(0).cast("bigint").alias("_events"),
                F.col("last_session").cast("bigint").alias("_base"),
            )
        )
    timeline = Window.partitionBy(user).orderBy("_bucket", "_start")
    idle = epoch_seconds("_start") - F.lag(epoch_seconds("_end")).over(timeline)
    opens = F.when(
        F.col("_base").isNull() & (idle.isNull() | (idle > gap_minutes * 60)), 1
    ).otherwise(0)
    return (
        spans.withColumn("_opens", opens)
        .withColumn(
            "_session",
            F.sum("_opens").over(timeline)
            + F.coalesce(F.first("_base", ignorenulls=True).over(timeline), F.lit(0)),
        )
        .where(F.col("_events") > 0)
    )


def sessionize(
    df: DataFrame,
    user_column: str = "user_id",
    timestamp_column: str = "timestamp",
    gap_minutes: int = 30,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Add ``computed_session_id``; a gap strictly longer than the limit opens a session.

    With ``carry`` (see ``session_state``) sessions and numbers continue those of
    the days before.
    """
    numbers = _numbered(df, user_column, timestamp_column, gap_minutes, carry).select(
        user_column, "_bucket", "_session"
    )
    bucketed = df.withColumn(
        "_bucket", time_bucket(timestamp_column, _bucket_seconds(gap_minutes))
    )
    return (
        bucketed.join(numbers, [user_column, "_bucket"], "left")
        .withColumn("computed_session_id", session_id(user_column, "_session"))
        .drop("_bucket", "_session")
    )


def session_state(
    sessions: DataFrame,
    previous: DataFrame | None = None,
    user_column: str = "user_id",
    timestamp_column: str = "timestamp",
) -> DataFrame:
    """Per user when they were last seen and in which session, for the next day's ``carry``."""
    number = F.substring_index("computed_session_id", "_", -1).cast("bigint")
    seen = sessions.select(
        user_column, F.col(timestamp_column).alias("last_seen"), number.alias("last_session")
    )
    if previous is not None:
        seen = seen.unionByName(previous)
    return (
        seen.where(F.col(user_column).isNotNull() & F.col("last_seen").isNotNull())
        .groupBy(user_column)
        .agg(F.max("last_seen").alias("last_seen"), F.max("last_session").alias("last_session"))
    )


def session_summary(
    df: DataFrame,
    user_column: str = "user_id",
    timestamp_column: str = "timestamp",
    gap_minutes: int = 30,
) -> DataFrame:
    """One row per session: id, start, end and number of events."""
    return (
        _numbered(df, user_column, timestamp_column, gap_minutes)
        .groupBy(user_column, "_session")
        .agg(
            F.min("_start").alias("session_start"),
            F.max("_end").alias("session_end"),
            F.sum("_events").alias("event_count"),
        )
        .select(
            user_column,
            session_id(user_column, "_session").alias("computed_session_id"),
            "session_start",
            "session_end",
            "event_count",
        )
    )


def session_gaps(
    df: DataFrame,
    user_column: str = "user_id",
    timestamp_column: str = "timestamp",
    id_column: str = "event_id",
) -> DataFrame:
    """Add ``gap_seconds`` to the user's previous event (NULL on the first).

    The gap is in whole seconds, so only the distinct active seconds of a user
    matter: the first event of a second carries the gap, later ones 0. Lag runs
    within a user's day; the first second of a day looks at the day before it.
    """
    second, day = epoch_seconds(timestamp_column), time_bucket(timestamp_column, DAY)
    place = F.struct(timestamp_column, id_column)
    timed = df.withColumns({"_second": second, "_day": day})
    seconds = timed.groupBy(user_column, "_day", "_second").agg(F.min(place).alias("_opener"))
    days = timed.groupBy(user_column, "_day").agg(F.max("_second").alias("_last"))
    days = days.select(
        user_column,
        "_day",
        F.lag("_last").over(Window.partitionBy(user_column).orderBy("_day")).alias("_before"),
    )
    in_day = Window.partitionBy(user_column, "_day").orderBy("_second")
    previous = (
        seconds.withColumn("_lag", F.lag("_second").over(in_day))
        .join(days, [user_column, "_day"])
        .select(
            user_column,
            "_second",
            "_opener",
            F.coalesce("_lag", "_before").alias("_previous"),
        )
    )
    return (
        timed.drop("_day")
        .join(previous, [user_column, "_second"], "left")
        .withColumn(
            "gap_seconds",
            F.when(place == F.col("_opener"), F.col("_second") - F.col("_previous")).otherwise(
                F.lit(0)
            ),
        )
        .drop("_second", "_opener", "_previous")
    )
