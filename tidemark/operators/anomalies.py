"""Outliers among a user's own values and among users' request rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import moments

MIN_SAMPLES = 5


def score_rows(
    df: DataFrame, baseline: DataFrame, metric_col: str, group_col: str = "user_id",
    threshold: float = 3.0, leave_one_out: bool = False,
) -> DataFrame:
    """``df`` with ``anomaly_zscore`` and ``is_anomaly`` by a baseline of moments per group.

    The baseline, one row per group, is dealt anew for the join: AQE splits a hot group's rows
    only where both sides come straight from a shuffle.
    """
    scored = df.join(baseline.hint("rebalance"), group_col, "left")
    scored = scored.withColumn("anomaly_zscore", moments.zscore(metric_col, MIN_SAMPLES, leave_one_out))
    scored = scored.withColumn("is_anomaly", F.col("anomaly_zscore") > F.lit(threshold))
    return scored.drop(*moments.COLUMNS)


def detect_zscore_anomalies(
    df: DataFrame,
    metric_col: str,
    group_col: str = "user_id",
    threshold: float = 3.0,
    leave_one_out: bool = False,
) -> DataFrame:
    """Add ``anomaly_zscore`` and ``is_anomaly`` (score strictly above the threshold).

    The score is 0 for groups with under five rows or no spread. A value is part
    of its own baseline, so no score can exceed (n - 1) / sqrt(n): groups of up to
    ten rows never pass 3. With ``leave_one_out`` a value is judged by the others of its
    group, of which there must be five.
    """
    baseline = moments.moments(df, metric_col, [group_col])
    return score_rows(df, baseline, metric_col, group_col, threshold, leave_one_out)


def flag_high_counts(counts: DataFrame, multiplier: float) -> DataFrame:
    """Flag counts above mean + multiplier x sd; both come from a one-row subquery."""
    spread = counts.agg(
        F.struct(
            F.coalesce(F.avg("request_count"), F.lit(0.0)).alias("mean"),
            F.coalesce(
                F.nullif(F.stddev_samp("request_count"), F.lit(0.0)), F.lit(1.0)
            ).alias("sd"),
        )
    )
    limit = F.col("_spread.mean") + F.lit(multiplier) * F.col("_spread.sd")
    return (
        counts.withColumn("_spread", spread.scalar())
        .withColumn("is_rate_anomaly", F.col("request_count") > limit)
        .drop("_spread")
    )


def detect_rate_anomalies(
    df: DataFrame,
    window_minutes: int | None = None,
    threshold_multiplier: float = 5.0,
    timestamp_column: str = "event_timestamp",
) -> DataFrame:
    """Requests per user, flagged when far above the others' (mean + multiplier x sd).

    Counts over the whole input, or per tumbling window of ``window_minutes``.
    """
    if window_minutes is None:
        counts = df.groupBy("user_id").agg(F.count("*").alias("request_count"))
        return flag_high_counts(counts, threshold_multiplier)
    span = F.window(F.col(timestamp_column), f"{window_minutes} minutes")
    counts = (
        df.groupBy("user_id", span.alias("_span"))
        .agg(F.count("*").alias("request_count"))
        .select("user_id", F.col("_span.start").alias("window_start"), "request_count")
    )
    return flag_high_counts(counts, threshold_multiplier)


def anomaly_summary(
    safety_events: DataFrame,
    api_usage: DataFrame,
    metric_col: str = "user_violation_count_30d",
    threshold: float = 3.0,
    threshold_multiplier: float = 5.0,
) -> DataFrame:
    """One row: behavioural, rate and total anomalies (0 on empty input)."""
    flagged = detect_zscore_anomalies(safety_events, metric_col, threshold=threshold)
    rates = detect_rate_anomalies(api_usage, threshold_multiplier=threshold_multiplier)
    hits = flagged.select(
        F.col("is_anomaly").alias("behavioral"), F.lit(False).alias("rate")
    ).unionByName(
        rates.select(F.lit(False).alias("behavioral"), F.col("is_rate_anomaly").alias("rate"))
    )
    return hits.agg(
        F.count_if("behavioral").alias("behavioral"), F.count_if("rate").alias("rate")
    ).withColumn("anomaly_count", F.col("behavioral") + F.col("rate"))
