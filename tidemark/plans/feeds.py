"""Small result tables that a monitoring page reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def run_health(runs: DataFrame) -> DataFrame:
    """Per job of a run log (job, run_at, status, duration_minutes): runs, success rate, duration."""
    return runs.groupBy("job").agg(
        F.count("*").alias("runs"),
        (F.count_if(F.col("status") == "success") / F.count("*")).alias("success_rate"),
        F.avg("duration_minutes").alias("avg_duration_minutes"),
    )


def recent_failures(runs: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` failed runs (a top-k: no full sort)."""
    return (
        runs.where(F.col("status") == "failed")
        .orderBy(F.desc("run_at"), "job")
        .limit(n)
        .select("run_at", "job", "duration_minutes")
    )


def unpivot_daily(daily: DataFrame, day: str, metrics: list[str]) -> DataFrame:
    """(day, metric, value), one row per metric and day."""
    longs = daily.select(day, *[F.col(m).cast("double").alias(m) for m in metrics])
    return longs.unpivot(day, metrics, "metric", "value")


def day_delta(daily: DataFrame, day: str, metrics: list[str]) -> DataFrame:
    """Each metric with its change since the day before it in the table.

    The window spans one metric of an already daily table, so a calendar's worth.
    """
    by_day = Window.partitionBy("metric").orderBy(day)
    return unpivot_daily(daily, day, metrics).withColumn(
        "delta", F.col("value") - F.lag("value").over(by_day)
    )


def violation_breakdown(safety_events: DataFrame) -> DataFrame:
    return safety_events.groupBy("violation_type").agg(F.count("*").alias("signals"))


def model_usage(api_usage: DataFrame) -> DataFrame:
    return api_usage.groupBy("model_id").agg(
        F.count("*").alias("requests"), F.sum("total_tokens").alias("tokens")
    )


def ranked(counts: DataFrame, name: str, by: str) -> DataFrame:
    """Grouped counts in order: each group's ``share`` of all and its ``rank`` from 1, ties by name.

    The window runs over one row per group of an already grouped table.
    """
    whole = Window.partitionBy(F.lit(0))
    order = whole.orderBy(F.desc(by), name)
    share = F.col(by) / F.sum(by).over(whole)
    return counts.withColumn("share", share).withColumn("rank", F.row_number().over(order)).orderBy("rank")


def daily_volume(ts: str = "event_timestamp", **sources: DataFrame) -> DataFrame:
    """Events per day and source; each source is counted before the union."""
    out = None
    for name, events in sources.items():
        counted = (
            events.groupBy(F.to_date(ts).alias("event_date"))
            .agg(F.count("*").alias("events"))
            .withColumn("source", F.lit(name))
        )
        out = counted if out is None else out.unionByName(counted)
    return out
