"""The daily batch: gate, dimensions, late arrivals, facts, gate, canonical metrics."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import quality
from ..operators.dedup import deduplicate_events
from ..operators.joins import resolve_keys
from ..operators.scd2 import empty_dimension, late_changes
from ..operators.sessions import session_state
from ..session import cut_lineage
from ..sources.staging import read_days
from ..sources.warehouse import Warehouse
from . import dims, facts, metrics
from .arrivals import REDELIVERY_DAYS, TABLES, arrived, load_arrivals, note_load, now_micros
from .hourly import HOUR, note_hours

TS = "event_timestamp"
GATED_TOPICS = ["user_events", "conversation_events", "api_usage_events", "billing_events"]


def _staged(spark: SparkSession, staging: str, topic: str, day: str) -> DataFrame:
    return read_days(spark, staging, topic, day).drop("dt", "hr", "_ingested_at")


def check_staging(
    spark: SparkSession, staging: str, day: str, tolerate: tuple[str, ...] = ()
) -> None:
    for topic in GATED_TOPICS:
        rules = quality.SUITES[topic]
        quality.gate(quality.run_checks(_staged(spark, staging, topic, day), rules), tolerate)


def load_dimensions(spark: SparkSession, staging: str, warehouse: Warehouse, day: str) -> None:
    """Snapshot of the day; without user changes the last snapshot stays the newest.

    Changes of earlier days that arrived since the last load are merged with the day's.
    Those too late for the merge are kept in RAW.LATE_USER_CHANGES.
    """
    began = now_micros(spark)
    events = _staged(spark, staging, "user_events", day)
    late, missing = arrived(spark, staging, warehouse, "user_events", before=day)
    if late is not None:
        events = events.unionByName(late.drop("dt", "hr", "_ingested_at"))
    changes = cut_lineage(dims.user_changes(events))
    if changes.isEmpty():
        # A rerun takes back what an earlier run of the day made of its changes.
        warehouse.drop_partition("LATE_USER_CHANGES", "RAW", "dt", day)
        dims.drop_users(warehouse, day)
    else:
        before = warehouse.read_snapshot(dims.HEADS, day, before=True)
        known = empty_dimension(changes, "changed_at") if before is None else before
        late = late_changes(known, changes, "user_id", "changed_at")
        late = late.withColumn("dt", F.lit(day).cast("date"))
        warehouse.write(late, "LATE_USER_CHANGES", "RAW", "replace", ["dt"], ("dt", day))
        dims.store_users(warehouse, changes, day)
    known_models = warehouse.read_snapshot("DIM_MODELS", day, before=True)
    warehouse.write_snapshot(dims.seed_models(spark, known_models), "DIM_MODELS", day)
    known_plans = warehouse.read_snapshot("DIM_SUBSCRIPTION_PLANS", day, before=True)
    plans = dims.seed_plans(spark, day, known_plans)
    warehouse.write_snapshot(plans, "DIM_SUBSCRIPTION_PLANS", day)
    year = F.lit(day).cast("date")
    span = spark.range(1).select(
        F.trunc(year, "year").alias("first_day"),
        F.last_day(F.add_months(F.trunc(year, "year"), 11)).alias("last_day"),
    )
    warehouse.write(dims.calendar(span), "DIM_TIME", mode="replace", partition_by=["year"])
    note_load(warehouse, "user_events", [*missing, day], began)


def _loaded_ids(warehouse: Warehouse, table: str, day: str) -> DataFrame | None:
    """Ids stored on the days before: copies of them may carry a later event day."""
    if not warehouse.exists(table):
        return None
    today = F.lit(day).cast("date")
    near = (F.col("dt") < today) & (F.col("dt") >= F.date_sub(today, REDELIVERY_DAYS))
    return warehouse.read(table).where(near).select("event_id")


def _store(
    warehouse: Warehouse, fact: DataFrame, table: str, day: str, schema: str = "WAREHOUSE"
) -> int:
    """Replace the day's partition; the rows are counted as they are written."""
    stored = fact.withColumns(
        {"_loaded_at": F.current_timestamp(), "dt": F.lit(day).cast("date")}
    )
    written = Observation()
    stored = stored.observe(written, F.count("*").alias("rows"))
    warehouse.write(stored, table, schema, "replace", ["dt"], ("dt", day))
    return written.get["rows"]


def load_facts(
    spark: SparkSession, staging: str, warehouse: Warehouse, day: str
) -> dict[str, int]:
    """Facts of the day, each replacing its own day's partition; returns their rows."""
    rows = {}
    users = dims.read_users(warehouse, day)
    models = warehouse.read_snapshot("DIM_MODELS", day)
    plans = warehouse.read_snapshot("DIM_SUBSCRIPTION_PLANS", day)

    def events(topic: str) -> DataFrame:
        return _staged(spark, staging, topic, day).withColumnRenamed("timestamp", TS)

    carry = warehouse.read_snapshot("SESSION_STATE", day, before=True)
    conversations = facts.fact_conversations(
        events("conversation_events"),
        loaded=_loaded_ids(warehouse, "FACT_CONVERSATIONS", day),
        carry=carry,
    )
    conversations = cut_lineage(conversations)
    state = session_state(conversations, carry, timestamp_column=TS)
    warehouse.write_snapshot(state, "SESSION_STATE", day)
    keyed = resolve_keys(conversations, TS, dim_users=users, dim_models=models)
    rows["FACT_CONVERSATIONS"] = _store(warehouse, keyed, "FACT_CONVERSATIONS", day)

    def unseen(fact: DataFrame, table: str) -> DataFrame:
        loaded = _loaded_ids(warehouse, table, day)
        return fact if loaded is None else fact.join(loaded, "event_id", "left_anti")

    calls = unseen(facts.fact_api_usage(events("api_usage_events")), "FACT_API_USAGE")
    calls = resolve_keys(calls, TS, dim_users=users, dim_models=models)
    rows["FACT_API_USAGE"] = _store(warehouse, calls, "FACT_API_USAGE", day)

    billing = unseen(facts.fact_billing(events("billing_events")), "FACT_BILLING")
    billing = resolve_keys(billing, TS, dim_users=users, dim_plans=plans)
    rows["FACT_BILLING"] = _store(warehouse, billing, "FACT_BILLING", day)
    return rows


def load_safety_events(
    spark: SparkSession, staging: str, warehouse: Warehouse, day: str
) -> int:
    signals = _staged(spark, staging, "safety_events", day).withColumnRenamed("timestamp", TS)
    unique = deduplicate_events(signals, timestamp_column=TS)
    return _store(warehouse, unique, "SAFETY_EVENTS", day, schema="RAW")


def build_canonical(warehouse: Warehouse, day: str, changed: list[str] = ()) -> None:
    """Metrics of the day, its week so far and its month so far.

    The same for the earlier days ``changed``, their weeks and their months.
    """
    conversations = warehouse.read("FACT_CONVERSATIONS")
    api_usage = warehouse.read("FACT_API_USAGE")
    billing = warehouse.read("FACT_BILLING")
    users = warehouse.read_snapshot("DIM_USERS", day)
    days = sorted({datetime.date.fromisoformat(d) for d in (*changed, day) if d <= day})
    today = days[-1]

    # Partition values bound the period for the scan; the metrics filter by event time.
    def within(first: datetime.date, last: datetime.date):
        return F.col("dt").between(F.lit(first), F.lit(last))

    def store(metric: DataFrame, table: str, period: str) -> None:
        computed = metric.withColumn("_computed_at", F.current_timestamp())
        warehouse.write(computed, table, "CANONICAL", "replace", [period])

    for d in days:
        facts_of_day = (f.where(within(d, d)) for f in (conversations, api_usage))
        store(metrics.daily_active_users(*facts_of_day, users, str(d)), "DAILY_ACTIVE_USERS", "event_date")
    for first in sorted({d - datetime.timedelta(days=d.weekday()) for d in days}):
        last = min(today, first + datetime.timedelta(days=6))
        week = metrics.weekly_engagement(conversations.where(within(first, last)), users, str(last))
        store(week, "WEEKLY_ENGAGEMENT", "week_start")
    for first in sorted({d.replace(day=1) for d in days}):
        end = (first + datetime.timedelta(days=31)).replace(day=1) - datetime.timedelta(days=1)
        last = min(today, end)
        store(metrics.monthly_revenue(billing.where(within(first, last)), str(last)), "MONTHLY_REVENUE", "month_start")


def check_warehouse(warehouse: Warehouse, day: str, tolerate: tuple[str, ...] = ()) -> None:
    loaded = warehouse.read("FACT_CONVERSATIONS").where(F.col("dt") == F.lit(day).cast("date"))
    results = quality.warehouse_checks(loaded, warehouse.read_snapshot("DIM_USERS", day), day)
    quality.gate(results, tolerate)


def run_day(
    spark: SparkSession,
    staging: str,
    warehouse: Warehouse,
    day: str,
    tolerate: tuple[str, ...] = (),
) -> dict[str, int]:
    """Everything for one day; running it again replaces the day's results.

    Events of earlier days that arrived since the last run are taken in as well, and the
    metrics of their periods are computed again. Returns the rows stored per table.

    ``tolerate`` names checks that may fail, such as ``unique:event_id`` where
    ingest delivers at least once and the fact jobs remove the copies.
    """
    check_staging(spark, staging, day, tolerate)
    load_dimensions(spark, staging, warehouse, day)
    began = now_micros(spark)  # what arrives from here on is for the next run
    late, changed = load_arrivals(spark, staging, warehouse, before=day)
    rows = load_facts(spark, staging, warehouse, day)
    rows["SAFETY_EVENTS"] = load_safety_events(spark, staging, warehouse, day)
    for topic in TABLES:
        note_load(warehouse, topic, [day], began)
    midnight = datetime.datetime.fromisoformat(day)
    note_hours(warehouse, [midnight + k * HOUR for k in range(24)], False)  # for the hourly run to read again
    rows["LATE_EVENTS"] = sum(late.values())
    check_warehouse(warehouse, day, tolerate)
    build_canonical(warehouse, day, changed)
    return rows
