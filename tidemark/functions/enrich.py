"""Derived columns of the fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# USD per million tokens (input, output) of the priced models.
TOKEN_PRICES = {
    "gpt-4o": (2.5, 10.0),
    "gpt-4o-mini": (0.15, 0.6),
    "gpt-4-turbo": (10.0, 30.0),
    "gpt-3.5-turbo": (0.5, 1.5),
}

# Billing event types by their effect on revenue.
REVENUE_IMPACT = {
    "positive": ["subscription_created", "payment_processed", "upgrade"],
    "negative": ["refund"],
    "at_risk": ["downgrade"],
}


def response_category(status: Column) -> Column:
    """HTTP status class; 429 is its own class, anything outside 200/4xx/5xx is unknown."""
    hundreds = F.floor(status / 100)
    return (
        F.when(status == 200, "success")
        .when(status == 429, "rate_limited")
        .when(hundreds == 4, "client_error")
        .when(hundreds == 5, "server_error")
        .otherwise("unknown")
    )


def _usd(input_tokens: Column, output_tokens: Column, per_in: Column, per_out: Column) -> Column:
    return (input_tokens * per_in + output_tokens * per_out) / F.lit(1_000_000)


def token_cost(model: Column, input_tokens: Column, output_tokens: Column) -> Column:
    """Estimated USD from the fixed price list; models not on it cost 0."""
    prices = F.create_map(
        *[
            part
            for name, pair in TOKEN_PRICES.items()
            for part in (F.lit(name), F.array(*[F.lit(p) for p in pair]))
        ]
    )
    pair = F.try_element_at(prices, model)
    cost = _usd(input_tokens, output_tokens, pair[0], pair[1])
    return F.when(pair.isNull(), F.lit(0.0)).otherwise(cost)


def token_cost_from_dim(df: DataFrame, dim_models: DataFrame) -> DataFrame:
    """Same estimate, priced by the model dimension (so newly added models cost something)."""
    prices = dim_models.select("model_id", "usd_per_1m_input", "usd_per_1m_output")
    return (
        df.join(prices, "model_id", "left")
        .withColumn(
            "estimated_cost_usd",
            F.coalesce(
                _usd(
                    F.col("input_tokens"),
                    F.col("output_tokens"),
                    F.col("usd_per_1m_input"),
                    F.col("usd_per_1m_output"),
                ),
                F.lit(0.0),
            ),
        )
        .drop("usd_per_1m_input", "usd_per_1m_output")
    )


def revenue_impact(event_type: Column) -> Column:
    impact = F.lit("neutral")
    for label, types in REVENUE_IMPACT.items():
        impact = F.when(event_type.isin(types), label).otherwise(impact)
    return impact


def requires_followup(event_type: Column, payment_status: Column) -> Column:
    """Failed payments; a NULL status needs no follow-up."""
    failed = (event_type == "payment_processed") & (payment_status == "failed")
    return F.coalesce(failed, F.lit(False))


def row_hash(columns: list[str]) -> Column:
    """md5 over the columns' text, joined by ``||``, NULL spelled ``__NULL__``."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("__NULL__")) for c in columns]
    return F.md5(F.concat_ws("||", *texts))


def surrogate_key(natural_key: str, valid_from: str) -> Column:
    """A key any rerun computes alike, unlike a sequence number."""
    return F.md5(F.concat_ws("|", F.col(natural_key), F.col(valid_from).cast("string")))
