"""Accounts to quarantine on the strength of recent safety signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Severities from mild to severe, and the thresholds.
SEVERITIES = ["low", "medium", "high", "critical"]
SEVERE_COUNT = 5
CRITICAL_CONFIDENCE = 0.7
LOOKBACK_DAYS = 30

REASON = "held after repeated severe or one confident critical signal"


def severity_rank(severity: Column) -> Column:
    """1 (low) to 4 (critical); 0 for anything else."""
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity).cast("int")


def quarantine_candidates(
    safety_events: DataFrame,
    as_of: str,
    active: DataFrame | None = None,
    timestamp_column: str = "event_timestamp",
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Users with five severe signals, or one critical signal of confidence >= 0.7.

    Looks back ``lookback_days`` from ``as_of``; accounts already quarantined in
    ``active`` are left out. Where ``active`` has ``reviewed_at``, a user's signals up
    to the last review that ended a hold have been judged and don't count again;
    without that time they do. The primary violation type is the most frequent one,
    the alphabetically first on a tie.
    """
    now = F.to_timestamp_ntz(F.lit(as_of))
    ts = F.col(timestamp_column)
    recent = safety_events.where(
        (ts < now) & (ts >= now - F.make_dt_interval(days=F.lit(lookback_days)))
    )
    if active is not None and "reviewed_at" in active.columns:
        ended = active.where(~F.col("is_active") & F.col("user_id").isNotNull())
        cleared = ended.groupBy("user_id").agg(F.max("reviewed_at").alias("_cleared"))
        recent = recent.join(cleared, "user_id", "left")
        recent = recent.where(F.col("_cleared").isNull() | (ts > F.col("_cleared"))).drop("_cleared")
    rank = severity_rank(F.coalesce(F.col("severity"), F.lit("")))
    sure = (F.col("severity") == "critical") & (F.col("confidence_score") >= CRITICAL_CONFIDENCE)
    per_type = recent.groupBy("user_id", "violation_type").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("severity").isin("high", "critical")).alias("severe"),
        F.max(rank).alias("rank"),
        F.max("confidence_score").alias("confidence"),
        F.coalesce(F.bool_or(sure), F.lit(False)).alias("sure"),
    )
    per_user = per_type.groupBy("user_id").agg(
        F.sum("n").alias("violation_count"),
        F.sum("severe").alias("severe_count"),
        F.max("rank").alias("rank"),
        F.max("confidence").alias("confidence_score"),
        F.bool_or("sure").alias("sure"),
        F.min(F.struct((-F.col("n")).alias("n"), "violation_type")).alias("primary"),
    )
    chosen = per_user.where((F.col("severe_count") >= SEVERE_COUNT) | F.col("sure"))
    if active is not None:
        held = active.where("is_active").select("user_id").distinct()
        chosen = chosen.join(held, "user_id", "left_anti")
    names = F.array(*[F.lit(s) for s in SEVERITIES])
    return chosen.select(
        "user_id",
        F.col("primary.violation_type").alias("violation_type"),
        F.when(F.col("rank") > 0, F.try_element_at(names, F.col("rank"))).alias("severity"),
        "violation_count",
        "confidence_score",
        now.alias("quarantined_at"),
        F.lit(None).cast("timestamp_ntz").alias("reviewed_at"),
        F.lit(None).cast("string").alias("review_outcome"),
        F.lit(True).alias("is_active"),
        F.lit(REASON).alias("quarantine_reason"),
    )
