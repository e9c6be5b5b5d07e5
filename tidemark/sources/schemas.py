"""One declared schema per topic: what ingest writes and every reader expects."""

from __future__ import annotations

from pyspark.sql.types import StructType

ENVELOPE_FIELDS = ["event_id", "event_type", "timestamp", "user_id"]
ENVELOPE = (
    "event_id string, event_type string, timestamp string, user_id string, "
    "payload map<string,string>"
)

_COMMON = "event_id string, event_type string, timestamp timestamp_ntz, user_id string"

# Payload fields by topic, over all event types of the topic.
PAYLOADS = {
    "user_events": (
        "email_hash string, display_name string, country_code string, user_tier string, "
        "platform string, referral_source string, organization_id string, ip_hash string, "
        "user_agent_hash string, auth_method string, old_tier string, new_tier string, "
        "reason string"
    ),
    "conversation_events": (
        "session_id string, conversation_id string, model_id string, platform string, "
        "topic_hint string, message_role string, input_tokens bigint, output_tokens bigint, "
        "total_tokens bigint, latency_ms bigint, turn_number int, is_streaming boolean, "
        "has_code_block boolean, has_image boolean, rating smallint, feedback_text_length int, "
        "total_turns int, session_duration_seconds bigint"
    ),
    "api_usage_events": (
        "api_key_hash string, endpoint string, model_id string, http_status_code int, "
        "input_tokens bigint, output_tokens bigint, total_tokens bigint, latency_ms bigint, "
        "is_streaming boolean, organization_id string, is_rate_limited boolean, request_id string"
    ),
    "billing_events": (
        "transaction_id string, plan_id string, currency string, billing_period_start date, "
        "billing_period_end date, amount_usd decimal(18,2), payment_method string, "
        "is_trial boolean, payment_status string, old_plan string, new_plan string, "
        "prorated_amount_usd decimal(18,2), effective_date date, reason string, "
        "original_transaction_id string"
    ),
    "safety_events": (
        "violation_type string, severity string, confidence_score double, session_id string, "
        "platform string, detection_method string, action_taken string, "
        "user_violation_count_30d bigint, injection_pattern string, requests_per_minute int, "
        "normal_rpm_baseline int, content_category string"
    ),
}

TOPICS = list(PAYLOADS)


def topic_schema(topic: str) -> StructType:
    """Flat schema of the topic: envelope fields, then payload fields."""
    return StructType.fromDDL(f"{_COMMON}, {PAYLOADS[topic]}")


def staging_schema(topic: str) -> StructType:
    """As written by ingest: plus ingestion time and the partition columns."""
    return StructType.fromDDL(
        f"{_COMMON}, {PAYLOADS[topic]}, _ingested_at timestamp, dt date, hr int"
    )
