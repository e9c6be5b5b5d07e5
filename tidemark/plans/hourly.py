"""The hourly safety run: detect, quarantine, dashboard.

An hour is read once. Its moments per user and value (SAFETY.USER_HOUR_SIGNALS) and its calls per
user (SAFETY.USER_HOUR_CALLS) are stored, and the look-back window is a sum of such rows: they say
how many signals of the window stand out, as a scan of it would. The hour's own signals that
stand out in the window as it is then are stored with their ids. A run handles
all hours of the window that no run has handled (SAFETY.HOUR_LEDGER): one, as a rule, all of them
the first time, and those to which late signals were added since.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import moments
from ..operators.anomalies import flag_high_counts, score_rows
from ..operators.quarantine import LOOKBACK_DAYS, quarantine_candidates
from ..session import cut_lineage, small_table
from ..sources.files import Files
from ..sources.warehouse import Warehouse
from .metrics import safety_dashboard

TS = "event_timestamp"
METRIC = "user_violation_count_30d"
QUARANTINE_SCHEMA = (
    "user_id string, violation_type string, severity string, violation_count bigint, "
    "confidence_score double, quarantined_at timestamp_ntz, reviewed_at timestamp_ntz, "
    "review_outcome string, is_active boolean, quarantine_reason string, quarantined_on date"
)
SIGNALS, CALLS, FLAGGED, LEDGER = "USER_HOUR_SIGNALS", "USER_HOUR_CALLS", "FLAGGED_SIGNALS", "HOUR_LEDGER"
HOUR = datetime.timedelta(hours=1)
#: As stored; a table may hold no row yet.
SCHEMAS = {
    SIGNALS: f"user_id string, {METRIC} bigint, n_rows bigint, n bigint, total decimal(28,4), squares decimal(38,8), dt date, hr int",
    CALLS: "user_id string, calls bigint, dt date, hr int",
    FLAGGED: f"event_id string, {TS} timestamp_ntz, anomaly_zscore double, user_id string, dt date, hr int",
}


def quarantined_accounts(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    if warehouse.exists("QUARANTINED_ACCOUNTS", "SAFETY"):
        return warehouse.read("QUARANTINED_ACCOUNTS", "SAFETY")
    return spark.createDataFrame([], QUARANTINE_SCHEMA)


def _window_hours(as_of: str) -> list[datetime.datetime]:
    """The hours of the look-back days that are over by ``as_of``."""
    end = datetime.datetime.fromisoformat(as_of).replace(minute=0, second=0, microsecond=0)
    start = datetime.datetime.combine(end.date(), datetime.time()) - datetime.timedelta(days=LOOKBACK_DAYS)
    return [start + k * HOUR for k in range(int((end - start) / HOUR))]


def note_hours(warehouse: Warehouse, hours: list[datetime.datetime], is_done: bool) -> None:
    """Marks hours as handled, or as changed since; the last mark of an hour counts."""
    if hours:
        rows = [(str(h), is_done) for h in hours]
        noted = small_table(warehouse.spark, rows, "hour string, is_done boolean")
        noted = noted.withColumn("at_micros", F.unix_micros(F.current_timestamp()))
        warehouse.write(noted.coalesce(1), LEDGER, "SAFETY", "append")


def pending_hours(warehouse: Warehouse, as_of: str) -> list[datetime.datetime]:
    """Hours of the window to handle; the ledger has a few rows per hour of the calendar."""
    hours = _window_hours(as_of)
    if not hours or not warehouse.exists(LEDGER, "SAFETY"):
        return hours
    ledger = warehouse.read(LEDGER, "SAFETY").where(F.col("hour") >= str(hours[0]))
    # of two marks at one time the one that asks for work counts
    last = ledger.groupBy("hour").agg(F.max_by("is_done", F.struct("at_micros", ~F.col("is_done"))).alias("is_done"))
    done = {r.hour for r in last.where("is_done").select("hour").collect()}
    return [h for h in hours if str(h) not in done]


def _rows_of(facts: DataFrame, hours: list[datetime.datetime]) -> DataFrame:
    """The rows of some hours; days are pruned, and the span is left to the files' statistics."""
    first, end = hours[0], hours[-1] + HOUR
    at = lambda h: F.lit(str(h)).cast("timestamp_ntz")
    span = (F.col(TS) >= at(first)) & (F.col(TS) < at(end))
    rows = facts.where(F.col("dt").between(F.lit(first.date()), F.lit(hours[-1].date()))).where(span)
    rows = rows.withColumn("hr", F.hour(TS))
    if len(hours) < (end - first) / HOUR:
        hour = F.date_trunc("hour", TS).cast("timestamp_ntz")
        rows = rows.where(hour.isin(*[at(h) for h in hours]))
    return rows


def _in_window(as_of: str) -> Column:
    """Condition on stored hours: those of the window."""
    hours = _window_hours(as_of)
    last = F.lit(hours[-1].date())
    return F.col("dt").between(F.lit(hours[0].date()), last) & ((F.col("dt") < last) | (F.col("hr") <= hours[-1].hour))


def _stored(warehouse: Warehouse, table: str) -> DataFrame:
    return warehouse.spark.read.schema(SCHEMAS[table]).parquet(warehouse.path("SAFETY", table))


def _replace(warehouse: Warehouse, rows: DataFrame, table: str, hours: list[datetime.datetime]) -> None:
    """Writes the rows of some hours; hours that have none any more lose theirs."""
    path, by_day = warehouse.path("SAFETY", table), {}
    for h in hours:
        by_day.setdefault(h.date(), set()).add(str(h.hour))
    files = Files(warehouse.spark, path)
    for day, numbers in by_day.items():
        for hr in numbers.intersection(files.values(f"{path}/dt={day}", "hr")):
            files.delete(f"{path}/dt={day}/hr={hr}")
    warehouse.write(rows, table, "SAFETY", "replace", ["dt", "hr"])


def window_moments(warehouse: Warehouse, as_of: str) -> DataFrame:
    """Per user the moments of the window, from stored hours."""
    return moments.merged(_stored(warehouse, SIGNALS).where(_in_window(as_of)), ["user_id"])


def window_calls(warehouse: Warehouse, as_of: str) -> DataFrame:
    parts = _stored(warehouse, CALLS).where(_in_window(as_of))
    return parts.groupBy("user_id").agg(F.sum("calls").alias("request_count"))


def handle_hours(warehouse: Warehouse, as_of: str, threshold: float = 3.0) -> list[datetime.datetime]:
    """Brings the stored hours up to ``as_of``; returns the hours handled."""
    hours = pending_hours(warehouse, as_of)
    if not hours:
        return hours
    signals = _rows_of(warehouse.read("SAFETY_EVENTS", "RAW"), hours)
    by = ["user_id", "dt", "hr"]
    _replace(warehouse, moments.moments(signals, METRIC, [*by, METRIC]), SIGNALS, hours)
    calls = _rows_of(warehouse.read("FACT_API_USAGE"), hours)
    _replace(warehouse, calls.groupBy(*by).agg(F.count(F.lit(1)).alias("calls")), CALLS, hours)
    judged = score_rows(signals, window_moments(warehouse, as_of), METRIC, threshold=threshold)
    flagged = judged.where("is_anomaly").select("event_id", TS, "anomaly_zscore", *by)
    _replace(warehouse, cut_lineage(flagged), FLAGGED, hours)
    note_hours(warehouse, hours, True)
    return hours


def window_summary(
    warehouse: Warehouse, as_of: str, threshold: float = 3.0, threshold_multiplier: float = 5.0
) -> DataFrame:
    """One row: signals that stand out in the window, users with far more calls than others, both.

    Equal to ``anomaly_summary`` over the window's rows, from stored hours only.
    """
    rates = flag_high_counts(window_calls(warehouse, as_of), threshold_multiplier)
    counts = rates.agg(F.count_if("is_rate_anomaly").alias("rate"))
    values = _stored(warehouse, SIGNALS).where(_in_window(as_of)).groupBy("user_id", METRIC).agg(F.sum("n_rows").alias("_times"))
    flagged = score_rows(values, window_moments(warehouse, as_of), METRIC, threshold=threshold).where("is_anomaly")
    flagged = flagged.agg(F.coalesce(F.sum("_times"), F.lit(0).cast("bigint")))
    counts = counts.select(flagged.scalar().alias("behavioral"), "rate")
    return counts.withColumn("anomaly_count", F.col("behavioral") + F.col("rate"))


def run_hour(spark: SparkSession, warehouse: Warehouse, as_of: str) -> dict[str, int]:
    """Returns the anomaly counts. Accounts are quarantined only if there are any.

    A rerun adds nothing: hours are handled once, accounts already held are left out, and the
    dashboard row of the day is replaced.
    """
    day = as_of[:10]
    now = F.lit(day).cast("date")
    handle_hours(warehouse, as_of)
    counts = window_summary(warehouse, as_of).first().asDict()
    recent = warehouse.read("SAFETY_EVENTS", "RAW").where(
        (F.col("dt") <= now) & (F.col("dt") >= F.date_sub(now, LOOKBACK_DAYS))
    )
    if counts["anomaly_count"] > 0:
        held = quarantined_accounts(spark, warehouse)
        new = quarantine_candidates(recent, as_of, active=held).withColumn("quarantined_on", now)
        warehouse.write(new, "QUARANTINED_ACCOUNTS", "SAFETY", "append", ["quarantined_on"])
    board = safety_dashboard(recent, quarantined_accounts(spark, warehouse), day, extended=True)
    board = board.withColumn("_computed_at", F.current_timestamp())
    warehouse.write(board, "SAFETY_DASHBOARD", "SAFETY", "replace", ["event_date"])
    return counts
