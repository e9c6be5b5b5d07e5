"""Canonical business metrics: daily, weekly, monthly, and the engagement score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.timestamps import on_day

TIERS = ["free", "plus", "enterprise"]
MOBILE = ["ios", "android"]

# Per component its cap and its weight in the score.
ENGAGEMENT_COMPONENTS = {
    "session": ("session_count", 10, 0.30),
    "message": ("message_count", 50, 0.25),
    "api": ("api_call_count", 100, 0.25),
    "diversity": ("models_used", 4, 0.20),
}


def _any(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def active_users(conversations: DataFrame, api_usage: DataFrame, *periods: str) -> DataFrame:
    """Per user (and period column) whether they used the API; one row per active user."""
    both = conversations.select(*periods, "user_id", F.lit(False).alias("via_api")).unionByName(
        api_usage.select(*periods, "user_id", F.lit(True).alias("via_api"))
    )
    return both.groupBy(*periods, "user_id").agg(F.bool_or("via_api").alias("via_api"))


def _dau(active: DataFrame, dim_users: DataFrame, day: Column, periods: list[str]) -> DataFrame:
    """Users are reduced to flags first, so one count per segment needs no distinct."""
    current = dim_users.where("is_current").select(
        "user_id", "user_tier", "platform", F.col("signup_date").cast("date").alias("signup_day")
    )
    flags = (
        active.join(current, "user_id", "left")
        .groupBy(*periods, "user_id")
        .agg(
            F.bool_or("via_api").alias("api"),
            *[_any(F.col("user_tier") == t).alias(t) for t in TIERS],
            _any(F.col("platform") == "web").alias("web"),
            _any(F.col("platform").isin(MOBILE)).alias("mobile"),
            _any(F.col("signup_day") == day).alias("new"),
        )
    )
    counted = flags.groupBy(*periods) if periods else flags
    return counted.agg(
        F.count("user_id").alias("total_dau"),
        *[F.count_if(F.col(t)).alias(f"dau_{t}") for t in TIERS],
        F.count_if("web").alias("dau_web"),
        F.count_if("mobile").alias("dau_mobile"),
        # NULL users are nobody: they count in no segment, as in total_dau.
        F.count_if(F.col("api") & F.col("user_id").isNotNull()).alias("dau_api"),
        F.count_if("new").alias("new_users_today"),
    ).withColumn("returning_users", F.col("total_dau") - F.col("new_users_today"))


def daily_active_users(
    conversations: DataFrame, api_usage: DataFrame, dim_users: DataFrame, day: str
) -> DataFrame:
    """One row for the day, all zero when nobody was active."""
    active = active_users(
        conversations.where(on_day("event_timestamp", day)),
        api_usage.where(on_day("event_timestamp", day)),
    )
    date = F.lit(day).cast("date")
    return _dau(active, dim_users, date, []).withColumn("event_date", date)


def daily_active_users_all(
    conversations: DataFrame, api_usage: DataFrame, dim_users: DataFrame
) -> DataFrame:
    """The same for each active day of the facts, in one pass (backfill)."""
    dated = [
        f.withColumn("event_date", F.to_date("event_timestamp")) for f in (conversations, api_usage)
    ]
    active = active_users(*dated, "event_date")
    return _dau(active, dim_users, F.col("event_date"), ["event_date"])


def week_start(ts: str | Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", ts).cast("date")


def month_start(ts: str | Column) -> Column:
    return F.trunc(ts, "month")


PERCENTILES = {"p50_latency_ms": 50, "p95_latency_ms": 95, "p99_latency_ms": 99}


def latency_percentiles(facts: DataFrame, by: list[str], accuracy: int | None = None) -> DataFrame:
    """p50, p95 and p99 of ``latency_ms`` per group, as values that occur in the data.

    Exact by default. Latencies are whole milliseconds, so rows are first counted
    per distinct value, which spreads a large group over many tasks; the running
    sum then sees one row per value. With ``accuracy`` a sketch per group is used,
    for latencies of unbounded resolution.
    """
    latency = F.col("latency_ms")
    if accuracy is not None:
        return facts.groupBy(*by).agg(
            *[F.percentile_approx(latency, p / 100, accuracy).alias(n) for n, p in PERCENTILES.items()]
        )
    counts = (
        facts.where(latency.isNotNull()).groupBy(*by, "latency_ms").agg(F.count("*").alias("_n"))
    )
    group = Window.partitionBy(*by)
    placed = counts.withColumns(
        {
            "_upto": F.sum("_n").over(group.orderBy("latency_ms")),
            "_all": F.sum("_n").over(group),
        }
    )
    return placed.groupBy(*by).agg(
        *[
            F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * p, latency)).alias(n)
            for n, p in PERCENTILES.items()
        ]
    )


def messages_per_session(messages: DataFrame, *periods: str) -> DataFrame:
    """Average number of messages per session (sessions without id count as one)."""
    sessions = messages.groupBy(*periods, "session_id").agg(F.count("*").alias("n"))
    counted = sessions.groupBy(*periods) if periods else sessions
    return counted.agg(F.avg("n").alias("avg_messages_per_session"))


def _per_session_and_model(messages: DataFrame, by: list[str]) -> DataFrame:
    """Counts and sums per group, session and model.

    Counting distinct sessions and models next to each other multiplies the rows;
    on this pre-aggregated frame there are few of them left.
    """
    return messages.groupBy(*by, "session_id", "model_id").agg(
        F.count("*").alias("messages"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("total_tokens", "latency_ms") for f in (F.sum, F.count)],
    )


def _average(column: str) -> Column:
    return F.try_divide(F.sum(f"sum_{column}").cast("double"), F.sum(f"count_{column}"))


def _engagement(messages: DataFrame, by: list[str], accuracy: int | None) -> DataFrame:
    counted = _per_session_and_model(messages, by).groupBy(*by).agg(
        F.count_distinct("session_id").alias("total_sessions"),
        F.sum("messages").alias("total_messages"),
        _average("total_tokens").alias("avg_tokens_per_message"),
        F.count_distinct("model_id").alias("unique_models_used"),
    )
    both = counted.unionByName(
        latency_percentiles(messages, by, accuracy), allowMissingColumns=True
    )
    # One row of each kind per group; unlike a join this keeps the NULL tier together.
    return both.groupBy(*by).agg(*[F.max(c).alias(c) for c in both.columns if c not in by])


def _messages_with_tier(conversations: DataFrame, dim_users: DataFrame) -> DataFrame:
    tiers = dim_users.where("is_current").select("user_id", "user_tier")
    messages = conversations.where(F.col("event_type") == "message_sent").select(
        "user_id", "event_timestamp", "session_id", "model_id", "total_tokens", "latency_ms"
    )
    return messages.join(tiers, "user_id", "left")


def weekly_engagement(
    conversations: DataFrame, dim_users: DataFrame, day: str, accuracy: int | None = None
) -> DataFrame:
    """The week (Monday to Sunday) around ``day``, one row per tier.

    Users without a current dimension row form the NULL tier. Messages per
    session is the average over all tiers, repeated on each row.
    """
    monday = week_start(F.lit(day).cast("date"))
    date = F.col("event_timestamp").cast("date")
    week = conversations.where(date.between(monday, F.date_add(monday, 6)))
    messages = _messages_with_tier(week, dim_users)
    overall = messages_per_session(week.where(F.col("event_type") == "message_sent"))
    return (
        _engagement(messages, ["user_tier"], accuracy)
        .withColumn("week_start", monday)
        .withColumn("avg_messages_per_session", overall.scalar())
    )


def weekly_engagement_all(
    conversations: DataFrame, dim_users: DataFrame, accuracy: int | None = None
) -> DataFrame:
    """Each week of the facts (backfill)."""
    dated = conversations.withColumn("week_start", week_start("event_timestamp"))
    messages = _messages_with_tier(conversations, dim_users).withColumn(
        "week_start", week_start("event_timestamp")
    )
    overall = messages_per_session(dated.where(F.col("event_type") == "message_sent"), "week_start")
    return _engagement(messages, ["week_start", "user_tier"], accuracy).join(
        overall, "week_start", "left"
    )


def _revenue(billing: DataFrame, periods: list[str], only_succeeded: bool) -> DataFrame:
    kind, amount = F.col("event_type"), F.col("amount_usd")
    if only_succeeded:
        failed = (kind == "payment_processed") & ~F.col("payment_status").eqNullSafe("succeeded")
        amount = F.when(~failed, amount)

    def total(*kinds: str) -> Column:
        money = F.sum(F.when(kind.isin(*kinds), amount))
        return F.coalesce(money, F.lit(0).cast("decimal(18,2)"))

    def times(name: str) -> Column:
        return F.count_if(kind == name)

    counted = billing.groupBy(*periods) if periods else billing
    return counted.agg(
        total("payment_processed", "subscription_created").alias("total_revenue_usd"),
        total("subscription_created").alias("subscription_revenue_usd"),
        total("payment_processed").alias("api_usage_revenue_usd"),
        times("subscription_created").alias("new_subscriptions"),
        times("downgrade").alias("churned_subscriptions"),
        times("upgrade").alias("upgrades"),
        times("downgrade").alias("downgrades"),
        total("refund").alias("refunds_usd"),
    ).withColumn(
        "mrr_usd",
        F.col("subscription_revenue_usd") + F.col("api_usage_revenue_usd") - F.col("refunds_usd"),
    )


def monthly_revenue(billing: DataFrame, day: str, only_succeeded: bool = False) -> DataFrame:
    """Month to date of ``day``, one row; amounts are decimals.

    Payments count whatever their status unless ``only_succeeded`` is set, and
    churn counts downgrades.
    """
    last = F.lit(day).cast("date")
    first = month_start(last)
    date = F.col("event_timestamp").cast("date")
    return _revenue(billing.where((date >= first) & (date <= last)), [], only_succeeded).withColumn(
        "month_start", first
    )


def monthly_revenue_all(billing: DataFrame, only_succeeded: bool = False) -> DataFrame:
    """Each whole month of the facts (backfill)."""
    dated = billing.withColumn("month_start", month_start("event_timestamp"))
    return _revenue(dated, ["month_start"], only_succeeded)


def safety_dashboard(
    safety_events: DataFrame, quarantined: DataFrame, day: str, extended: bool = False
) -> DataFrame:
    """Signals and quarantines of the day in one row, zeros on a quiet day.

    ``extended`` adds the share of reviewed accounts found to be false positives
    and the mean time from a user's first signal to the quarantine.
    """
    signals = safety_events.where(on_day("event_timestamp", day)).select(
        "violation_type", "confidence_score", F.lit(True).alias("is_signal")
    )
    accounts = quarantined.where(on_day("quarantined_at", day))
    columns = ["is_active", "review_outcome"]
    if extended:
        first = safety_events.groupBy("user_id").agg(F.min("event_timestamp").alias("first_signal"))
        accounts = accounts.join(first, "user_id", "left").withColumn(
            "detect_seconds",
            F.unix_micros(F.col("quarantined_at").cast("timestamp")) / 1e6
            - F.unix_micros(F.col("first_signal").cast("timestamp")) / 1e6,
        )
        columns.append("detect_seconds")
    both = signals.unionByName(accounts.select(*columns), allowMissingColumns=True)
    outcome = F.col("review_outcome")

    def seen(violation: str) -> Column:
        return F.count_if(F.col("violation_type") == violation)

    measures = [
        F.count("is_signal").alias("total_safety_signals"),
        seen("prompt_injection").alias("prompt_injection_attempts"),
        seen("jailbreak_attempt").alias("jailbreak_attempts"),
        seen("rate_limit_abuse").alias("rate_limit_violations"),
        seen("content_policy_violation").alias("content_policy_flags"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.count_if("is_active").alias("accounts_quarantined"),
        F.count_if(outcome == "released").alias("accounts_released"),
    ]
    if extended:
        wrong = F.count_if(outcome == "false_positive")
        measures += [
            F.try_divide(wrong, F.count(outcome)).alias("false_positive_rate"),
            F.avg("detect_seconds").alias("mean_time_to_detect_seconds"),
        ]
    return both.agg(*measures).withColumn("event_date", F.lit(day).cast("date"))


def conversation_user_days(conversations: DataFrame) -> DataFrame:
    """Sessions, messages, tokens, models and latency per user and day."""
    messages = conversations.where(F.col("event_type") == "message_sent").withColumn(
        "event_date", F.to_date("event_timestamp")
    )
    days = ["user_id", "event_date"]
    return _per_session_and_model(messages, days).groupBy(*days).agg(
        F.count_distinct("session_id").alias("session_count"),
        F.sum("messages").alias("message_count"),
        _average("total_tokens").alias("avg_tokens"),
        F.count_distinct("model_id").alias("models_used"),
        _average("latency_ms").alias("avg_latency_ms"),
    )


def api_user_days(api_usage: DataFrame) -> DataFrame:
    """Successful calls and their tokens per user and day."""
    return (
        api_usage.where(F.col("http_status_code") == 200)
        .groupBy("user_id", F.to_date("event_timestamp").alias("event_date"))
        .agg(
            F.count("*").alias("api_call_count"),
            F.sum("total_tokens").alias("total_api_tokens"),
        )
    )


def normalize(column: str, cap: int) -> Column:
    """Share of the cap, between 0 and 1; NULL is 0."""
    share = F.col(column).cast("double") / F.lit(cap)
    return F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)), F.lit(0.0))


def engagement_score(conversations: DataFrame, api_usage: DataFrame) -> DataFrame:
    """Weighted activity score (0 to 1) per user and day active in either source."""
    days = conversation_user_days(conversations).join(
        api_user_days(api_usage), ["user_id", "event_date"], "full_outer"
    )
    scored = days.select(
        "user_id",
        "event_date",
        *[source for source, _, _ in ENGAGEMENT_COMPONENTS.values()],
        *[
            normalize(source, cap).alias(f"{name}_score")
            for name, (source, cap, _) in ENGAGEMENT_COMPONENTS.items()
        ],
    )
    terms = [
        F.col(f"{name}_score") * F.lit(weight)
        for name, (_, _, weight) in ENGAGEMENT_COMPONENTS.items()
    ]
    return scored.withColumn("engagement_score", terms[0] + terms[1] + terms[2] + terms[3])
