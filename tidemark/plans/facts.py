"""Fact tables from staged events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.enrich import requires_followup, response_category, revenue_impact, token_cost
from ..functions.text import apply_pii_masking, free_text_columns
from ..operators.dedup import deduplicate_events, drop_already_loaded
from ..operators.sessions import sessionize
from ..session import cut_lineage


def fact_conversations(
    events: DataFrame,
    timestamp_column: str = "event_timestamp",
    gap_minutes: int = 30,
    loaded: DataFrame | None = None,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Deduplicated, sessionized, free text masked.

    Events whose id is in ``loaded`` were stored by an earlier run and are left
    out; ``carry`` continues that run's sessions. Sessionizing reads its input
    twice (numbering and rows), so the unique events are stored once in between.
    """
    unique = deduplicate_events(events, timestamp_column=timestamp_column)
    if loaded is not None:
        unique = drop_already_loaded(unique, loaded)
    sessions = sessionize(
        cut_lineage(unique),
        timestamp_column=timestamp_column,
        gap_minutes=gap_minutes,
        carry=carry,
    )
    return apply_pii_masking(sessions, free_text_columns(sessions))


def fact_api_usage(events: DataFrame, timestamp_column: str = "event_timestamp") -> DataFrame:
    """Deduplicated, with response category and estimated cost."""
    return deduplicate_events(events, timestamp_column=timestamp_column).withColumns(
        {
            "response_category": response_category(F.col("http_status_code")),
            "estimated_cost_usd": token_cost(
                F.col("model_id"), F.col("input_tokens"), F.col("output_tokens")
            ),
        }
    )


def fact_billing(events: DataFrame, timestamp_column: str = "event_timestamp") -> DataFrame:
    """Deduplicated, with revenue impact and follow-up flag."""
    return deduplicate_events(events, timestamp_column=timestamp_column).withColumns(
        {
            "revenue_impact": revenue_impact(F.col("event_type")),
            "requires_followup": requires_followup(F.col("event_type"), F.col("payment_status")),
        }
    )
