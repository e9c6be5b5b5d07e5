"""Jobs that keep state between runs, as queries over whole tables: stored, run in steps, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import anomalies, moments, retention
from tidemark.operators.scd2 import merge_heads, split_versions
from tidemark.plans import arrivals, dims, facts, feeds, hourly, metrics
from tidemark.session import scratch_dir
from tidemark.sources import compaction, staging, topics
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import ingest

from . import inputs
from .queries import AS_OF, RETENTION_AS_OF, TS, VERSION_COLUMNS, _activity, _event_stream, _retained, query, rounded


def _place(spark: SparkSession, label: str) -> tuple[str, Warehouse]:
    """Folders of a staging area and a warehouse that nothing else uses."""
    root = scratch_dir(spark, label)
    return f"{root}/staging", Warehouse(spark, f"{root}/warehouse")


def _land(events: DataFrame, root: str, topic: str, writer: str) -> None:
    flat = topics.flatten(topics.decode(topics.to_records(events)), topic)
    landed = staging.with_partitions(flat).withColumn("_ingested_at", F.current_timestamp())
    staging.write_days(landed, root, topic, writer)


@query
def late_events_loaded(spark, sf_dir):
    """Every fifth message arrives after the others were loaded; a third load finds nothing new."""
    root, warehouse = _place(spark, "late")
    events = inputs.conversation_events(spark, sf_dir)
    is_late = F.col("event_id").cast("bigint") % 5 == 0
    for part, writer in ((events.where(~is_late), "first"), (events.where(is_late), "second")):
        _land(part, root, "conversation_events", writer)
        arrivals.load_arrivals(spark, root, warehouse)
    arrivals.load_arrivals(spark, root, warehouse)
    return warehouse.read("FACT_CONVERSATIONS").select("event_id", TS, "user_id", "computed_session_id")


@query
def copy_after_three_days(spark, sf_dir):
    """Every third call is delivered again, under an event day three days on."""
    root, warehouse = _place(spark, "copies")
    events = inputs.api_usage_events(spark, sf_dir)
    again = events.where(F.col("event_id").cast("bigint") % 3 == 0)
    again = again.withColumn(TS, F.col(TS) + F.expr("interval '3' days"))
    for part, writer in ((events, "first"), (again, "second")):
        _land(part, root, "api_usage_events", writer)
        arrivals.load_arrivals(spark, root, warehouse)
    stored = warehouse.read("FACT_API_USAGE")
    return stored.groupBy("dt").agg(
        F.count("*").alias("calls"),
        F.sum(F.col("estimated_cost_usd").cast("decimal(18,9)")).alias("cost_usd"),
    )


def _hours(spark, sf_dir) -> Warehouse:
    """Hours handled up to the day before AS_OF, then those of the last day."""
    _, warehouse = _place(spark, "hours")
    for events, table, schema in (
        (inputs.safety_events(spark, sf_dir), "SAFETY_EVENTS", "RAW"),
        (inputs.api_usage_events(spark, sf_dir), "FACT_API_USAGE", "WAREHOUSE"),
    ):
        warehouse.write(events.withColumn("dt", F.to_date(TS)), table, schema, "replace", ["dt"])
    hourly.handle_hours(warehouse, "2024-01-30 00:00:00")
    hourly.handle_hours(warehouse, AS_OF)
    return warehouse


@query
def hourly_increment(spark, sf_dir):
    """Each user's baseline of 30 days, from stored hours."""
    warehouse = _hours(spark, sf_dir)
    base = hourly.window_moments(warehouse, AS_OF).withColumns({"mean": moments.mean(), "sd": moments.spread()})
    calls = hourly.window_calls(warehouse, AS_OF).withColumnRenamed("request_count", "calls")
    both = base.join(calls, "user_id", "left").withColumn("calls", F.coalesce("calls", F.lit(0)))
    return rounded(both.select("user_id", "n_rows", "mean", "sd", "calls"), "mean", "sd")


@query
def hourly_summary(spark, sf_dir):
    return hourly.window_summary(_hours(spark, sf_dir), AS_OF)


@query
def zscore_leave_one_out(spark, sf_dir):
    scored = anomalies.detect_zscore_anomalies(
        inputs.safety_events(spark, sf_dir), "user_violation_count_30d", leave_one_out=True
    )
    return rounded(scored.select("event_id", "user_id", "anomaly_zscore", "is_anomaly"), "anomaly_zscore")


@query
def scd2_open_only(spark, sf_dir):
    """The merge on heads alone, put together with the versions closed before and by it."""
    heads, closed = split_versions(inputs.dim_users(spark, sf_dir), "user_id")
    heads, more = merge_heads(
        heads, inputs.user_batch(spark, sf_dir), "user_id", dims.TRACKED_COLUMNS, effective_column="changed_at"
    )
    whole = heads.unionByName(more)
    whole = whole.unionByName(closed.withColumn("change_kind", F.lit("history")), allowMissingColumns=True)
    return whole.select("signup_date", *VERSION_COLUMNS)


@query
def compacted_hour(spark, sf_dir):
    """Two writers land each hour; its folders are merged, and the rows stay."""
    root, _ = _place(spark, "compaction")
    events = inputs.conversation_events(spark, sf_dir)
    for n in range(2):
        _land(events.where(F.col("event_id").cast("bigint") % 2 == n), root, "conversation_events", f"w{n}")
    compaction.compact(spark, root, "conversation_events")
    stored = staging.read_days(spark, root, "conversation_events", "2000-01-01", "2100-01-01")
    return stored.groupBy("dt", "hr").agg(F.count("*").alias("events"), F.sum("total_tokens").alias("tokens"))


@query
def stream_dedup_hot(spark, sf_dir):
    """A third of what arrives are copies of one id; the stream lets each id through once."""
    events = _event_stream(spark, sf_dir)
    hot = events.where(F.col("event_id").cast("bigint") % 2 == 0).withColumn("event_id", F.lit("1"))
    out = scratch_dir(spark, "stream-hot")
    ingest.run_to_end(ingest.drop_redeliveries(events.unionByName(hot), TS), f"{out}/events", f"{out}/_checkpoint")
    return spark.read.parquet(f"{out}/events").groupBy("event_id").agg(F.count("*").alias("times"))


@query
def retention_delete(spark, sf_dir):
    """All eight tables stored, expired rows deleted, the rest counted; deletions as the log has them."""
    _, warehouse = _place(spark, "retention")
    tables = dict(_retained(spark, sf_dir))
    conversations, api = _activity(spark, sf_dir)
    users, bills = inputs.dim_users(spark, sf_dir), inputs.billing_events(spark, sf_dir)
    tables["CANONICAL.DAILY_ACTIVE_USERS"] = metrics.daily_active_users_all(conversations, api, users)
    tables["CANONICAL.WEEKLY_ENGAGEMENT"] = metrics.weekly_engagement_all(conversations, users)
    tables["CANONICAL.MONTHLY_REVENUE"] = metrics.monthly_revenue_all(facts.fact_billing(bills))
    for table, rows in tables.items():
        schema, name = table.split(".")
        policy = retention.POLICIES[table]
        if policy.same_day:
            rows = rows.withColumn(policy.period, F.to_date(policy.age))
        else:  # computed on the day the period begins
            rows = rows.withColumn(policy.age, F.col(policy.period).cast("timestamp_ntz"))
        warehouse.write(rows, name, schema, "replace", [policy.period])
    retention.apply_all_retention(warehouse, RETENTION_AS_OF)
    out = None
    for table in tables:
        schema, name = table.split(".")
        gone = not warehouse.partitions(name, schema)
        rows = spark.range(0) if gone else warehouse.read(name, schema)
        counted = rows.agg(F.count(F.lit(1)).alias("kept_rows")).withColumn("table_name", F.lit(table))
        out = counted if out is None else out.unionByName(counted)
    log = warehouse.read("RETENTION_AUDIT_LOG", "RAW").select("table_name", "records_deleted")
    out = out.join(log, "table_name", "left")
    return out.select("table_name", "kept_rows", F.coalesce("records_deleted", F.lit(0)).alias("deleted_rows"))


@query
def model_ranking(spark, sf_dir):
    usage = feeds.model_usage(inputs.api_usage_events(spark, sf_dir))
    return rounded(feeds.ranked(usage, "model_id", "requests"), "share")


@query
def violation_ranking(spark, sf_dir):
    signals = feeds.violation_breakdown(inputs.safety_events(spark, sf_dir))
    return rounded(feeds.ranked(signals, "violation_type", "signals"), "share")


@query
def seed_merge_filled(spark, sf_dir):
    """Seeds merged into a dimension that knows the models of one family, at a price of its own."""
    calls = inputs.api_usage_events(spark, sf_dir).where(F.col("model_id").startswith("gpt-"))
    known = calls.groupBy("model_id").agg(F.count("*").alias("calls")).withColumn("usd_per_1m_input", F.lit(0.0))
    merged = dims.seed_models(spark, known)
    return merged.select("model_id", "usd_per_1m_input", F.coalesce("calls", F.lit(0)).alias("calls"))
