"""Loading by arrival: events that came in since the last load, whatever day they belong to.

The daily job reads one event day. What arrives after its day was loaded is found by a ledger,
RAW.LOAD_LEDGER: which event days of a topic were loaded, and up to what time all arrivals were
taken in. The next load reads the files landed since then, less an allowance for writers
that commit late, and days that the ledger lacks. Ids stored on the event days concerned, and
some days around them, are left out, so that copies and repeated loads add nothing.

Calls, bills and signals are appended to their event day. Messages may join or split sessions
that are stored already: the sessions of just the users concerned are numbered again from the
last kept state on, and only days on which a stored number changed are written anew.

The state of sessions is written before the facts, and the ledger last: a load that broke off
is repeated as a whole, and its second run ends where the first one would have.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import apply_pii_masking, free_text_columns
from ..operators.dedup import deduplicate_events, drop_already_loaded
from ..operators.joins import resolve_keys
from ..operators.sessions import session_state, sessionize
from ..session import cut_lineage, small_table
from ..sources.files import Files
from ..sources.staging import read_arrived, read_days
from ..sources.warehouse import Warehouse
from .dims import read_users
from .facts import fact_api_usage, fact_billing
from .hourly import note_hours

TS = "event_timestamp"
LEDGER = "LOAD_LEDGER"
#: Writers may commit this long after the ingestion time they stamp.
OVERLAP_SECONDS = 3600
#: A copy of an event may carry an event day this far from the first one.
REDELIVERY_DAYS = 7
_STATE = "SESSION_STATE"


def now_micros(spark: SparkSession) -> int:
    return spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]


def note_load(warehouse: Warehouse, topic: str, days: list[str], until_micros: int) -> None:
    """One row per event day that was loaded; none for a load that only took late arrivals."""
    rows = [(topic, d, until_micros) for d in days or [None]]
    noted = small_table(warehouse.spark, rows, "topic string, day string, until_micros bigint")
    warehouse.write(noted.coalesce(1), LEDGER, "RAW", "append")


def loaded_days(warehouse: Warehouse, topic: str) -> tuple[set[str], int | None]:
    """Event days of the topic that were loaded, and when the last load began."""
    if not warehouse.exists(LEDGER, "RAW"):
        return set(), None
    of = warehouse.read(LEDGER, "RAW").where(F.col("topic") == topic)
    row = of.agg(F.collect_set("day").alias("days"), F.max("until_micros").alias("until")).first()
    return set(row.days), row.until  # one value per day of the calendar


def arrived(
    spark: SparkSession, staging: str, warehouse: Warehouse, topic: str, before: str | None = None,
    overlap_seconds: int = OVERLAP_SECONDS,
) -> tuple[DataFrame | None, list[str]]:
    """Staged rows of days before ``before`` that no load has taken in, and the days never loaded."""
    loaded, until = loaded_days(warehouse, topic)
    staged = Files(spark, staging).values(f"{staging}/{topic}", "dt")
    staged = [d for d in staged if d[0].isdigit() and (before is None or d < before)]
    missing = [d for d in staged if d not in loaded]
    rows = None
    if missing:
        days = F.col("dt").isin([datetime.date.fromisoformat(d) for d in missing])
        rows = read_days(spark, staging, topic, missing[0], missing[-1]).where(days)
    if until is not None and len(missing) < len(staged):
        late = read_arrived(spark, staging, topic, until - overlap_seconds * 1_000_000)
        if before is not None:
            late = late.where(F.col("dt") < F.lit(before).cast("date"))
        if missing:
            late = late.where(~days)
        rows = late if rows is None else rows.unionByName(late)
    return rows, missing


def _around(days: list[datetime.date], reach: int) -> list[datetime.date]:
    return sorted({d + datetime.timedelta(days=k) for d in days for k in range(-reach, reach + 1)})


def unseen(
    warehouse: Warehouse, events: DataFrame, table: str, schema: str, days: list[datetime.date],
    reach: int = REDELIVERY_DAYS,
) -> DataFrame:
    """One row per id that isn't stored on ``days`` or within ``reach`` days of them."""
    unique = deduplicate_events(events, timestamp_column=TS)
    if not warehouse.exists(table, schema):
        return unique
    stored = warehouse.read(table, schema).where(F.col("dt").isin(_around(days, reach)))
    return drop_already_loaded(unique, stored)


def append_facts(warehouse: Warehouse, fact: DataFrame, table: str, schema: str = "WAREHOUSE") -> int:
    """Adds rows, which are stored already in between, to their event days; returns how many."""
    rows = fact.count()
    if rows:
        stored = fact.withColumns({"_loaded_at": F.current_timestamp(), "dt": F.to_date(TS)})
        warehouse.write(stored, table, schema, "append", ["dt"])
    return rows


def _states(warehouse: Warehouse, first: str, last: str) -> list[str]:
    """Days whose session state the new rows concern: those kept from ``first`` on, and ``last``."""
    kept = [d for _, d in warehouse.partitions(_STATE) if d >= first]
    return sorted({*kept, last})


def add_conversations(
    warehouse: Warehouse, events: DataFrame, resolve: Callable[[DataFrame], DataFrame], table: str = "FACT_CONVERSATIONS"
) -> tuple[int, list[str]]:
    """Adds unseen messages; returns how many, and the days on which stored rows were renumbered.

    ``resolve`` adds the surrogate keys to new rows; stored rows keep theirs.
    """
    new = cut_lineage(apply_pii_masking(events, free_text_columns(events)).withColumn("dt", F.to_date(TS)))
    span = new.agg(F.min("dt").alias("first"), F.max("dt").alias("last"), F.count(F.lit(1)).alias("rows")).first()
    if not span.rows:
        return 0, []
    first, last = str(span.first), str(span.last)
    users = new.select("user_id").distinct()
    kept = [d for _, d in warehouse.partitions(_STATE) if d < first]
    carry = warehouse.read_snapshot(_STATE, max(kept)) if kept else None
    carried = None if carry is None else carry.join(users, "user_id", "left_semi")
    rows = new.withColumn("_stored", F.lit(False))
    before = warehouse.read(table) if warehouse.exists(table) else None
    if before is not None:
        since = before.where(F.col("dt") > F.lit(max(kept)).cast("date")) if kept else before
        old = since.join(users, "user_id", "left_semi").withColumnRenamed("computed_session_id", "_was")
        rows = rows.unionByName(old.withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    else:
        rows = rows.withColumn("_was", F.lit(None).cast("string"))
    rows = cut_lineage(sessionize(cut_lineage(rows), timestamp_column=TS, carry=carried))

    for day in _states(warehouse, first, last):
        then = rows.where(F.col("dt") <= F.lit(day).cast("date"))
        state = session_state(then, carried, timestamp_column=TS)
        whole = warehouse.read_snapshot(_STATE, day)
        if whole is not None:
            state = state.unionByName(whole.join(users, "user_id", "left_anti").select(*state.columns))
        warehouse.write_snapshot(cut_lineage(state), _STATE, day)

    fresh = resolve(rows.where(~F.col("_stored")).select(*new.columns, "computed_session_id").drop("dt"))
    moved = rows.where(F.col("_stored") & ~F.col("_was").eqNullSafe(F.col("computed_session_id")))
    days = [r.dt for r in moved.select("dt").distinct().collect()] if before is not None else []
    if days:
        columns = [c for c in before.columns if c != "computed_session_id"]
        again = before.where(F.col("dt").isin(days))
        rest = again.join(moved.select("event_id"), "event_id", "left_anti")
        whole = rest.unionByName(moved.select(*columns, "computed_session_id"))
        warehouse.write(whole, table, mode="replace", partition_by=["dt"])
    return append_facts(warehouse, cut_lineage(fresh), table), sorted(map(str, days))


def load_arrivals(
    spark: SparkSession, staging: str, warehouse: Warehouse, before: str | None = None,
    overlap_seconds: int = OVERLAP_SECONDS,
) -> tuple[dict[str, int], list[str]]:
    """Takes in what arrived for days before ``before`` (any day without it).

    Returns the rows added per table and the event days whose facts changed. Days that were
    never loaded are loaded whole, so that a skipped run is made up for.
    """
    day = before or "9999-12-31"
    users = read_users(warehouse, day)
    models, plans = (warehouse.read_snapshot(t, day) for t in ("DIM_MODELS", "DIM_SUBSCRIPTION_PLANS"))
    added, changed = {}, set()
    for topic, (table, schema) in TABLES.items():
        began = now_micros(spark)
        rows, missing = arrived(spark, staging, warehouse, topic, before, overlap_seconds)
        days = [] if rows is None else [r.dt for r in rows.select("dt").distinct().collect()]  # days of the calendar
        added[table] = 0
        if days:
            events = rows.drop("dt", "hr", "_ingested_at").withColumnRenamed("timestamp", TS)
            new = unseen(warehouse, events, table, schema, days)
            if topic == "conversation_events":
                keys = lambda f: resolve_keys(f, TS, dim_users=users, dim_models=models)
                new = cut_lineage(new)
                added[table], renumbered = add_conversations(warehouse, new, keys, table)
                changed.update(renumbered)
            else:
                new = cut_lineage(FACTS[topic](new, users, models, plans))
                added[table] = append_facts(warehouse, new, table, schema)
                if topic in ("safety_events", "api_usage_events"):
                    hours = new.select(F.date_trunc("hour", TS).cast("timestamp_ntz").alias("hour")).distinct()
                    note_hours(warehouse, [r.hour for r in hours.collect()], False)  # hours of the calendar
            if added[table]:
                changed.update(str(r.dt) for r in new.select(F.to_date(TS).alias("dt")).distinct().collect())
        if days or missing:
            note_load(warehouse, topic, missing, began)
    return added, sorted(changed)


def _calls(events: DataFrame, users, models, plans) -> DataFrame:
    return resolve_keys(fact_api_usage(events), TS, dim_users=users, dim_models=models)


def _bills(events: DataFrame, users, models, plans) -> DataFrame:
    return resolve_keys(fact_billing(events), TS, dim_users=users, dim_plans=plans)


def _signals(events: DataFrame, users, models, plans) -> DataFrame:
    return deduplicate_events(events, timestamp_column=TS)


TABLES = {
    "conversation_events": ("FACT_CONVERSATIONS", "WAREHOUSE"),
    "api_usage_events": ("FACT_API_USAGE", "WAREHOUSE"),
    "billing_events": ("FACT_BILLING", "WAREHOUSE"),
    "safety_events": ("SAFETY_EVENTS", "RAW"),
}
FACTS = {"api_usage_events": _calls, "billing_events": _bills, "safety_events": _signals}
