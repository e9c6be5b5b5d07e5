"""Every operator as a query over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import enrich, text
from tidemark.functions.timestamps import on_day
from tidemark.operators import anomalies, joins, quality, quarantine, retention, sessions
from tidemark.operators.dedup import deduplicate_events
from tidemark.operators.scd2 import apply_scd_type2, empty_dimension, keys_with_many_current, late_changes
from tidemark.plans import dims, facts, feeds, metrics
from tidemark.session import scratch_dir
from tidemark.sources import staging, topics
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import ingest

from . import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "2024-01-15"
AS_OF = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2026-01-15 00:00:00"
TS = "event_timestamp"


def plain(df: DataFrame) -> DataFrame:
    """Column types that any two engines print alike."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources and sinks -----------------------------------------------------------


def _staged(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Conversation events landed as dt/hr Parquet in a new folder; returns its root."""
    root = scratch_dir(spark, label)
    records = topics.to_records(inputs.conversation_events(spark, sf_dir))
    events = topics.flatten(topics.decode(records), "conversation_events")
    landed = staging.with_partitions(events).withColumn("_ingested_at", F.current_timestamp())
    staging.write_days(landed, root, "conversation_events")
    return root


@query
def scan_partition_day(spark, sf_dir):
    root = _staged(spark, sf_dir, "scan")
    day = staging.read_days(spark, root, "conversation_events", DAY)
    return day.groupBy("dt", "hr", "event_type").agg(F.count("*").alias("events"))


@query
def write_partition_roundtrip(spark, sf_dir):
    """Fact written twice by day: the rerun of one day replaces just that day."""
    warehouse = Warehouse(spark, scratch_dir(spark, "roundtrip"))
    fact = facts.fact_api_usage(inputs.api_usage_events(spark, sf_dir))
    fact = fact.withColumn("dt", F.to_date(TS))
    warehouse.write(fact, "FACT_API_USAGE", mode="replace", partition_by=["dt"])
    again = fact.where(on_day(TS, DAY))
    warehouse.write(again, "FACT_API_USAGE", mode="replace", partition_by=["dt"])
    stored = warehouse.read("FACT_API_USAGE")
    return stored.groupBy("dt").agg(
        F.count("*").alias("calls"),
        F.sum(F.col("estimated_cost_usd").cast("decimal(18,9)")).alias("cost_usd"),
    )


@query
def backfill_jsonl_flatten(spark, sf_dir):
    path = scratch_dir(spark, "jsonl")
    topics.to_records(inputs.api_usage_events(spark, sf_dir)).write.text(path)
    events = topics.flatten(
        topics.decode(topics.read_json_lines(spark, path)), "api_usage_events"
    )
    return events.select(
        "event_id", "event_type", "timestamp", "user_id", "model_id", "http_status_code", "total_tokens"
    )


@query
def flatten_events(spark, sf_dir):
    records = topics.to_records(inputs.conversation_events(spark, sf_dir))
    events = topics.flatten(topics.decode(records), "conversation_events")
    return events.select(
        "event_id",
        "event_type",
        "timestamp",
        "user_id",
        "session_id",
        "model_id",
        "total_tokens",
        "latency_ms",
        "feedback_text_length",
    )


def _event_stream(spark, sf_dir) -> DataFrame:
    """The events table as a file stream, as JSON records."""
    schema = inputs.table(spark, sf_dir, "events").schema
    source = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return _streamed(source)


def _streamed(source) -> DataFrame:
    kind = F.col("event_type")
    return source.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(kind == "signup", "session_start")
        .when(kind == "error", "conversation_rated")
        .otherwise("message_sent")
        .alias("event_type"),
        F.col("ts").alias(TS),
        inputs.uid("user_id").alias("user_id"),
        F.floor(F.col("value") * 10).alias("latency_ms"),
    )


@query
def stream_ingest(spark, sf_dir):
    root = scratch_dir(spark, "landing")
    records = topics.to_records(_event_stream(spark, sf_dir))
    ingest.land_topic(records, "conversation_events", root, f"{root}/_checkpoints", None).awaitTermination()
    return _landed(spark, root)


def _landed(spark, root):
    landed = staging.read_days(spark, root, "conversation_events", "2000-01-01", "2100-01-01")
    return landed.groupBy("dt", "hr", "event_type").agg(
        F.count("*").alias("events"), F.sum("latency_ms").alias("latency_ms")
    )


@query
def stream_then_backfill(spark, sf_dir):
    """The stream and a backfill of the same hours land in one folder; both stay."""
    root = scratch_dir(spark, "landing")
    records = topics.to_records(_event_stream(spark, sf_dir))
    ingest.land_topic(records, "conversation_events", root, f"{root}/_checkpoints", None).awaitTermination()
    records = topics.to_records(_streamed(inputs.table(spark, sf_dir, "events")))
    events = staging.with_partitions(topics.flatten(topics.decode(records), "conversation_events"))
    staging.write_days(events.withColumn("_ingested_at", F.current_timestamp()), root, "conversation_events")
    return _landed(spark, root)


@query
def stream_dedup(spark, sf_dir):
    """Each rating arrives twice; the stream lets one of the two through."""
    events = _event_stream(spark, sf_dir)
    again = events.where(F.col("event_type") == "conversation_rated")
    out = scratch_dir(spark, "stream-dedup")
    unique = ingest.drop_redeliveries(events.unionByName(again), TS)
    ingest.run_to_end(unique, f"{out}/events", f"{out}/_checkpoint")
    return spark.read.parquet(f"{out}/events").select("event_id", "event_type", TS, "user_id")


@query
def stream_sessions(spark, sf_dir):
    out = scratch_dir(spark, "stream-sessions")
    sessions = ingest.stream_sessions(_event_stream(spark, sf_dir), TS)
    ingest.run_to_end(sessions, f"{out}/sessions", f"{out}/_checkpoint")
    return spark.read.parquet(f"{out}/sessions")


# --- filters and cleaning --------------------------------------------------------


@query
def filter_day(spark, sf_dir):
    events = inputs.conversation_events(spark, sf_dir)
    return events.where(on_day(TS, DAY)).select("event_id", "user_id", TS)


@query
def dedup_latest(spark, sf_dir):
    events = inputs.redelivered_conversation_events(spark, sf_dir)
    return deduplicate_events(events, timestamp_column=TS).select("event_id", TS, "event_type")


@query
def dedup_earliest(spark, sf_dir):
    events = inputs.redelivered_conversation_events(spark, sf_dir)
    kept = deduplicate_events(events, timestamp_column=TS, order="asc")
    return kept.select("event_id", TS, "event_type")


@query
def session_gaps(spark, sf_dir):
    events = inputs.conversation_events(spark, sf_dir)
    return sessions.session_gaps(events, timestamp_column=TS).select("event_id", "user_id", "gap_seconds")


@query
def sessionize(spark, sf_dir):
    events = inputs.conversation_events(spark, sf_dir)
    return sessions.sessionize(events, timestamp_column=TS).select("event_id", "computed_session_id")


@query
def sessionize_5min(spark, sf_dir):
    events = inputs.conversation_events(spark, sf_dir)
    out = sessions.sessionize(events, timestamp_column=TS, gap_minutes=5)
    return out.select("event_id", "computed_session_id")


@query
def session_summary(spark, sf_dir):
    return sessions.session_summary(inputs.conversation_events(spark, sf_dir), timestamp_column=TS)


@query
def pii_mask(spark, sf_dir):
    masked = text.apply_pii_masking(inputs.texts(spark, sf_dir), ["text"])
    return masked.select("doc_id", F.md5("text").alias("masked_md5"))


@query
def pii_mask_auto(spark, sf_dir):
    events = inputs.conversation_events(spark, sf_dir)
    masked = text.apply_pii_masking(events, text.free_text_columns(events))
    return masked.select("event_id", "message_role", "message_text", "feedback_text_length")


# --- enrichment and facts --------------------------------------------------------


@query
def api_response_category(spark, sf_dir):
    calls = inputs.api_usage_events(spark, sf_dir)
    return (
        calls.groupBy(
            "http_status_code",
            enrich.response_category(F.col("http_status_code")).alias("response_category"),
        )
        .agg(F.count("*").alias("calls"))
    )


@query
def api_cost_case(spark, sf_dir):
    calls = inputs.api_usage_events(spark, sf_dir)
    cost = enrich.token_cost(F.col("model_id"), F.col("input_tokens"), F.col("output_tokens"))
    return rounded(calls.select("event_id", "model_id", cost.alias("cost_usd")), "cost_usd", digits=9)


@query
def api_cost_dim(spark, sf_dir):
    priced = enrich.token_cost_from_dim(
        inputs.api_usage_events(spark, sf_dir), inputs.models(spark)
    )
    out = priced.select("event_id", "model_id", F.col("estimated_cost_usd").alias("cost_usd"))
    return rounded(out, "cost_usd", digits=9)


@query
def billing_revenue_impact(spark, sf_dir):
    billing = inputs.billing_events(spark, sf_dir)
    impact = enrich.revenue_impact(F.col("event_type")).alias("revenue_impact")
    return billing.groupBy("event_type", impact).agg(
        F.count("*").alias("events"), F.sum("amount_usd").alias("amount_usd")
    )


@query
def billing_followup(spark, sf_dir):
    billing = inputs.billing_events(spark, sf_dir)
    flag = enrich.requires_followup(F.col("event_type"), F.col("payment_status"))
    return billing.select("event_id", flag.alias("requires_followup"))


@query
def row_hash(spark, sf_dir):
    users = inputs.dim_users(spark, sf_dir)
    return users.select(
        "user_id", "is_current", enrich.row_hash(dims.TRACKED_COLUMNS).alias("row_hash")
    )


@query
def fact_conversations(spark, sf_dir):
    fact = facts.fact_conversations(inputs.redelivered_conversation_events(spark, sf_dir))
    return fact.select("event_id", TS, "user_id", "computed_session_id", "message_text", "total_tokens")


@query
def fact_api_usage(spark, sf_dir):
    fact = facts.fact_api_usage(inputs.api_usage_events(spark, sf_dir))
    out = fact.select("event_id", TS, "user_id", "response_category", "estimated_cost_usd")
    return rounded(out, "estimated_cost_usd", digits=9)


@query
def fact_billing(spark, sf_dir):
    fact = facts.fact_billing(inputs.billing_events(spark, sf_dir))
    return fact.select(
        "event_id", TS, "user_id", "amount_usd", "revenue_impact", "requires_followup"
    )


# --- dimensions ------------------------------------------------------------------

VERSION_COLUMNS = [
    "user_id",
    "user_tier",
    "country_code",
    "display_name",
    "organization_id",
    "account_status",
    "valid_from",
    "valid_to",
    "is_current",
    "change_kind",
]


@query
def user_changes(spark, sf_dir):
    return dims.user_changes(inputs.user_events(spark, sf_dir))


@query
def scd2_merge(spark, sf_dir):
    return inputs.merged_users(spark, sf_dir).select("user_sk", "signup_date", *VERSION_COLUMNS)


@query
def scd2_initial_load(spark, sf_dir):
    loaded = dims.merge_users(None, dims.user_changes(inputs.user_events(spark, sf_dir)))
    return loaded.select(*VERSION_COLUMNS)


def _merged_rows(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        merged = inputs.merged_users(spark, sf_dir)
        return plain(merged.where(F.col("change_kind") == kind).select(*VERSION_COLUMNS))

    return run


QUERIES["scd2_unchanged"] = _merged_rows("unchanged")
QUERIES["scd2_expired"] = _merged_rows("expired")
QUERIES["scd2_new_versions"] = _merged_rows("new_version")
QUERIES["scd2_new_keys"] = _merged_rows("new_key")
QUERIES["scd2_untouched"] = _merged_rows("untouched")
QUERIES["scd2_history"] = _merged_rows("history")


@query
def scd2_one_current(spark, sf_dir):
    """Current rows per user and users breaking the rule of one, after the merge."""
    merged = inputs.stored_users(spark, sf_dir)
    broken = keys_with_many_current(merged, "user_id")
    return merged.where("is_current").agg(
        F.count("*").alias("current_rows"), F.count_distinct("user_id").alias("users")
    ).withColumn("broken_users", broken.agg(F.count("*")).scalar())


@query
def scd2_same_instant(spark, sf_dir):
    """Quarter of the day in which each user is seen, by the hour: repeats share an instant."""
    events = inputs.table(spark, sf_dir, "events")
    changes = events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.floor(F.hour("ts") / 6).cast("string").alias("state"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("changed_at"),
    )
    never = empty_dimension(changes, "changed_at")
    merged = apply_scd_type2(never, changes, "user_id", ["state"], effective_column="changed_at")
    return merged.select("user_id", "state", "valid_from", "valid_to", "is_current")


@query
def scd2_null_keys(spark, sf_dir):
    """Changes without key or time open no version and are reported, one row per reason and state."""
    events = inputs.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    changes = events.select(
        F.when(kind != "error", F.col("user_id").cast("string")).alias("user_id"),
        kind.alias("state"),
        F.when(kind != "signup", F.col("ts").cast("timestamp_ntz")).alias("changed_at"),
    )
    apart = late_changes(empty_dimension(changes, "changed_at"), changes, "user_id", "changed_at")
    return apart.groupBy(
        "state", F.col("user_id").isNull().alias("no_key"), F.col("changed_at").isNull().alias("no_time")
    ).agg(F.count("*").alias("changes"))


@query
def dim_users_current(spark, sf_dir):
    users = inputs.dim_users(spark, sf_dir).where("is_current")
    return users.select("user_id", "user_tier", "platform", "signup_date")


@query
def merge_insert_if_absent(spark, sf_dir):
    """Users seen in events are added where the dimension lacks them."""
    known = inputs.dim_users(spark, sf_dir).where("is_current").select("user_id", "user_tier")
    seen = (
        inputs.conversation_events(spark, sf_dir)
        .groupBy("user_id")
        .agg(F.lit("unknown").alias("user_tier"))
    )
    return joins.merge_insert_if_absent(known, seen, "user_id")


@query
def dim_models(spark, sf_dir):
    """Seeds merged into the models seen in API usage."""
    seen = inputs.api_usage_events(spark, sf_dir).groupBy("model_id").agg(
        F.count("*").alias("calls")
    )
    dim = dims.seed_models(spark)
    return dim.join(seen, "model_id", "left").select(
        "model_id", "model_family", "context_window", "usd_per_1m_input", "usd_per_1m_output",
        "release_date", F.coalesce("calls", F.lit(0)).alias("calls"),
    )


@query
def dim_plans(spark, sf_dir):
    seen = inputs.billing_events(spark, sf_dir).groupBy("plan_id").agg(
        F.count("*").alias("billings")
    )
    dim = inputs.plans(spark)
    return dim.join(seen, "plan_id", "left").select(
        "plan_id", "plan_name", "monthly_price_usd", "rate_limit_rpm", "valid_from",
        F.coalesce("billings", F.lit(0)).alias("billings"),
    )


@query
def dim_time(spark, sf_dir):
    """Calendar over the days the billing facts cover."""
    return dims.calendar(dims.days_covered(inputs.billing_events(spark, sf_dir)))


@query
def pit_user_join(spark, sf_dir):
    """Each conversation event with the tier its user had at that time."""
    events = inputs.conversation_events(spark, sf_dir).select("event_id", "user_id", TS)
    versions = inputs.stored_users(spark, sf_dir)
    return joins.join_valid_at(events, versions, "user_id", TS, ["user_tier", "country_code"])


@query
def pit_ties(spark, sf_dir):
    """Orders as versions of their customer that may start on one day; the greatest key holds."""
    orders = inputs.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("timestamp_ntz")
    key = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).alias("user_id")
    versions = orders.select(
        key, F.date_trunc("year", day).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.col("o_orderkey").alias("held"),
    )
    facts = orders.select(F.col("o_orderkey").alias("order_id"), key, day.alias("ordered_at"))
    return joins.join_valid_at(facts, versions, "user_id", "ordered_at", ["held"]).drop("ordered_at")


@query
def rerun_empty_day(spark, sf_dir):
    """A rerun that yields no rows leaves none of its day."""
    warehouse = Warehouse(spark, scratch_dir(spark, "rerun"))
    fact = facts.fact_api_usage(inputs.api_usage_events(spark, sf_dir)).withColumn("dt", F.to_date(TS))
    warehouse.write(fact, "FACT_API_USAGE", mode="replace", partition_by=["dt"])
    none = fact.where(F.lit(False))
    warehouse.write(none, "FACT_API_USAGE", mode="replace", partition_by=["dt"], period=("dt", DAY))
    return warehouse.read("FACT_API_USAGE").groupBy("dt").agg(F.count("*").alias("calls"))


@query
def fact_with_keys(spark, sf_dir):
    fact = inputs.api_usage_events(spark, sf_dir).select("event_id", "user_id", "model_id", TS)
    users = inputs.stored_users(spark, sf_dir)
    keyed = joins.resolve_keys(fact, TS, dim_users=users, dim_models=inputs.models(spark))
    return keyed.select("event_id", "date_key", "user_sk", "model_sk")


@query
def billing_with_keys(spark, sf_dir):
    fact = inputs.billing_events(spark, sf_dir).select("event_id", "user_id", "plan_id", TS)
    keyed = joins.resolve_keys(fact, TS, dim_plans=inputs.plans(spark))
    return keyed.select("event_id", "date_key", "plan_sk")


@query
def orphan_facts(spark, sf_dir):
    """Bills of users that no user event names."""
    return joins.orphan_counts(inputs.billing_events(spark, sf_dir), inputs.user_events(spark, sf_dir))


# --- metrics ---------------------------------------------------------------------


def _activity(spark, sf_dir):
    return inputs.conversation_events(spark, sf_dir), inputs.api_usage_events(spark, sf_dir)


@query
def active_users_union(spark, sf_dir):
    conversations, api = _activity(spark, sf_dir)
    return metrics.active_users(
        conversations.where(on_day(TS, DAY)), api.where(on_day(TS, DAY))
    )


@query
def daily_active_users(spark, sf_dir):
    conversations, api = _activity(spark, sf_dir)
    return metrics.daily_active_users(conversations, api, inputs.dim_users(spark, sf_dir), DAY)


@query
def daily_active_users_all(spark, sf_dir):
    conversations, api = _activity(spark, sf_dir)
    return metrics.daily_active_users_all(conversations, api, inputs.dim_users(spark, sf_dir))


ENGAGEMENT_DOUBLES = ["avg_tokens_per_message", "avg_messages_per_session"]


@query
def weekly_engagement(spark, sf_dir):
    conversations = inputs.conversation_events(spark, sf_dir)
    week = metrics.weekly_engagement(conversations, inputs.dim_users(spark, sf_dir), DAY)
    return rounded(week, *ENGAGEMENT_DOUBLES)


@query
def weekly_engagement_all(spark, sf_dir):
    conversations = inputs.conversation_events(spark, sf_dir)
    weeks = metrics.weekly_engagement_all(conversations, inputs.dim_users(spark, sf_dir))
    return rounded(weeks, *ENGAGEMENT_DOUBLES)


@query
def messages_per_session(spark, sf_dir):
    messages = inputs.conversation_events(spark, sf_dir).where("event_type = 'message_sent'")
    return rounded(metrics.messages_per_session(messages), "avg_messages_per_session")


@query
def latency_percentiles(spark, sf_dir):
    return metrics.latency_percentiles(inputs.api_usage_events(spark, sf_dir), ["model_id"])


@query
def monthly_revenue(spark, sf_dir):
    return metrics.monthly_revenue(inputs.billing_events(spark, sf_dir), "1998-05-20")


@query
def monthly_revenue_all(spark, sf_dir):
    return metrics.monthly_revenue_all(inputs.billing_events(spark, sf_dir))


@query
def monthly_revenue_succeeded(spark, sf_dir):
    return metrics.monthly_revenue_all(inputs.billing_events(spark, sf_dir), only_succeeded=True)


@query
def conv_user_day(spark, sf_dir):
    days = metrics.conversation_user_days(inputs.conversation_events(spark, sf_dir))
    return rounded(days, "avg_tokens", "avg_latency_ms")


@query
def api_user_day(spark, sf_dir):
    return metrics.api_user_days(inputs.api_usage_events(spark, sf_dir))


@query
def engagement_score(spark, sf_dir):
    conversations, api = _activity(spark, sf_dir)
    score = metrics.engagement_score(conversations, api)
    return rounded(
        score, "session_score", "message_score", "api_score", "diversity_score", "engagement_score"
    )


@query
def safety_dashboard(spark, sf_dir):
    board = metrics.safety_dashboard(
        inputs.safety_events(spark, sf_dir), inputs.quarantined_accounts(spark, sf_dir), DAY
    )
    return rounded(board, "avg_confidence")


@query
def safety_dashboard_ext(spark, sf_dir):
    board = metrics.safety_dashboard(
        inputs.safety_events(spark, sf_dir),
        inputs.quarantined_accounts(spark, sf_dir),
        DAY,
        extended=True,
    )
    board = rounded(board, "avg_confidence", "false_positive_rate")
    return rounded(board, "mean_time_to_detect_seconds", digits=3)


# --- safety ----------------------------------------------------------------------


@query
def zscore_anomalies(spark, sf_dir):
    scored = anomalies.detect_zscore_anomalies(
        inputs.safety_events(spark, sf_dir), "user_violation_count_30d"
    )
    return rounded(scored.select("event_id", "user_id", "anomaly_zscore", "is_anomaly"), "anomaly_zscore")


@query
def zscore_flagged(spark, sf_dir):
    scored = anomalies.detect_zscore_anomalies(
        inputs.safety_events(spark, sf_dir), "user_violation_count_30d"
    )
    return scored.where("is_anomaly").select("event_id", "user_id", "user_violation_count_30d")


@query
def rate_anomalies(spark, sf_dir):
    return anomalies.detect_rate_anomalies(inputs.api_usage_events(spark, sf_dir))


@query
def rate_anomalies_2sd(spark, sf_dir):
    return anomalies.detect_rate_anomalies(
        inputs.api_usage_events(spark, sf_dir), threshold_multiplier=2.0
    )


@query
def rate_anomalies_hourly(spark, sf_dir):
    return anomalies.detect_rate_anomalies(
        inputs.api_usage_events(spark, sf_dir), window_minutes=60
    )


@query
def anomaly_summary(spark, sf_dir):
    return anomalies.anomaly_summary(
        inputs.safety_events(spark, sf_dir), inputs.api_usage_events(spark, sf_dir)
    )


@query
def injection_scores(spark, sf_dir):
    scored = text.detect_injections(inputs.texts(spark, sf_dir), "text")
    return scored.select("doc_id", "injection_risk_score", "injection_pattern")


@query
def detect_injections(spark, sf_dir):
    turns = inputs.table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.concat("text", F.when(F.col("role") == "user", F.lit(" Act as if you agree; system: ")).otherwise("")).alias("text"),
    )
    scored = text.detect_injections(turns, "text", threshold=0.8)
    return scored.select("conv_id", "turn", "injection_risk_score", "is_injection_attempt")


@query
def injection_summary(spark, sf_dir):
    return text.injection_summary(inputs.texts(spark, sf_dir), "text")


@query
def quarantine_candidates(spark, sf_dir):
    """Candidates, minus the accounts already held."""
    return quarantine.quarantine_candidates(
        inputs.safety_events(spark, sf_dir), AS_OF, active=inputs.quarantined_accounts(spark, sf_dir)
    ).select(
        "user_id", "violation_type", "severity", "violation_count",
        F.round("confidence_score", 6).alias("confidence_score"), "quarantined_at", "is_active",
    )


@query
def quarantine_after_release(spark, sf_dir):
    """Reviews come three days after a hold: only later signals of a released user count."""
    held = inputs.quarantined_accounts(spark, sf_dir)
    reviewed = F.col("quarantined_at") + F.expr("interval '3' days")
    held = held.withColumn("reviewed_at", F.when(F.col("review_outcome").isNotNull(), reviewed))
    held = held.withColumn("is_active", F.lit(False))
    return quarantine.quarantine_candidates(
        inputs.safety_events(spark, sf_dir), AS_OF,
        active=held.where(F.col("reviewed_at") <= F.lit(AS_OF).cast("timestamp_ntz")),
    ).select(
        "user_id", "violation_type", "severity", "violation_count",
        F.round("confidence_score", 6).alias("confidence_score"), "quarantined_at", "is_active",
    )


@query
def quarantine_all(spark, sf_dir):
    return quarantine.quarantine_candidates(inputs.safety_events(spark, sf_dir), "2024-02-10 00:00:00").select(
        "user_id", "violation_type", "severity", "violation_count",
        F.round("confidence_score", 6).alias("confidence_score"), "quarantine_reason",
    )


# --- quality ---------------------------------------------------------------------

STAGED: dict[str, Query] = {
    "conversation_events": lambda spark, sf_dir: inputs.redelivered_conversation_events(
        spark, sf_dir
    ).withColumnRenamed(TS, "timestamp"),
    "api_usage_events": inputs.api_usage_events,
    "billing_events": inputs.billing_events,
    "user_events": inputs.user_events,
}


def _checks(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return quality.run_checks(STAGED[topic](spark, sf_dir), quality.SUITES[topic])


def _per_topic(judge: Callable[[DataFrame], DataFrame], spark, sf_dir) -> DataFrame:
    out = None
    for topic in STAGED:
        one = judge(_checks(spark, sf_dir, topic)).withColumn("topic", F.lit(topic))
        out = one if out is None else out.unionByName(one)
    return out


@query
def quality_staging(spark, sf_dir):
    return _per_topic(lambda results: results, spark, sf_dir)


@query
def quality_suite_summary(spark, sf_dir):
    return _per_topic(quality.suite_summary, spark, sf_dir)


@query
def warehouse_checks(spark, sf_dir):
    return quality.warehouse_checks(
        inputs.conversation_events(spark, sf_dir), inputs.dim_users(spark, sf_dir), DAY
    )


@query
def reconcile_counts(spark, sf_dir):
    staged = inputs.redelivered_conversation_events(spark, sf_dir)
    return quality.reconcile_counts(staged, deduplicate_events(staged, timestamp_column=TS))


# --- retention -------------------------------------------------------------------


def _retained(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "RAW.SAFETY_EVENTS": inputs.safety_events(spark, sf_dir),
        "WAREHOUSE.FACT_CONVERSATIONS": inputs.conversation_events(spark, sf_dir),
        "WAREHOUSE.FACT_API_USAGE": inputs.api_usage_events(spark, sf_dir),
        "WAREHOUSE.FACT_BILLING": inputs.billing_events(spark, sf_dir),
        "SAFETY.QUARANTINED_ACCOUNTS": inputs.quarantined_accounts(spark, sf_dir),
    }


def _expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, rows in _retained(spark, sf_dir).items():
        one = retention.expired_count(rows, name, RETENTION_AS_OF)
        out = one if out is None else out.unionByName(one)
    return out


@query
def retention_expired_counts(spark, sf_dir):
    return _expired(spark, sf_dir)


@query
def retention_policies(spark, sf_dir):
    """The policy of each table, with its expired share (NULL where no table is given)."""
    counts = _expired(spark, sf_dir).select("table_name", "expired_rows")
    return retention.policies(spark).join(counts, "table_name", "left")


@query
def retention_audit(spark, sf_dir):
    return retention.audit_rows(_expired(spark, sf_dir), RETENTION_AS_OF)


@query
def retention_keep(spark, sf_dir):
    kept = retention.keep_unexpired(
        inputs.conversation_events(spark, sf_dir), "WAREHOUSE.FACT_CONVERSATIONS", RETENTION_AS_OF
    )
    return kept.groupBy(F.to_date(TS).alias("event_date")).agg(F.count("*").alias("events"))


# --- monitoring feeds ------------------------------------------------------------


@query
def run_health(spark, sf_dir):
    health = feeds.run_health(inputs.run_log(spark, sf_dir))
    return rounded(health, "success_rate", "avg_duration_minutes")


@query
def recent_failures(spark, sf_dir):
    return feeds.recent_failures(inputs.run_log(spark, sf_dir))


@query
def daily_volume(spark, sf_dir):
    conversations, api = _activity(spark, sf_dir)
    return feeds.daily_volume(
        conversations=conversations, api_calls=api, billing=inputs.billing_events(spark, sf_dir)
    )


DAU_METRICS = ["total_dau", "dau_free", "dau_plus", "dau_enterprise"]


@query
def unpivot_daily_metrics(spark, sf_dir):
    return feeds.unpivot_daily(daily_active_users_all(spark, sf_dir), "event_date", DAU_METRICS)


@query
def metric_day_delta(spark, sf_dir):
    return feeds.day_delta(daily_active_users_all(spark, sf_dir), "event_date", DAU_METRICS)


@query
def violation_breakdown(spark, sf_dir):
    return feeds.violation_breakdown(inputs.safety_events(spark, sf_dir))


@query
def model_usage(spark, sf_dir):
    return feeds.model_usage(inputs.api_usage_events(spark, sf_dir))
