import datetime
import decimal

from conftest import at, plan_of
from pyspark.sql import functions as F

from tidemark.functions.enrich import (
    requires_followup,
    response_category,
    revenue_impact,
    row_hash,
    token_cost,
    token_cost_from_dim,
)
from tidemark.plans import dims, feeds, metrics

CONV = (
    "event_id string, event_type string, user_id string, event_timestamp timestamp_ntz, "
    "session_id string, model_id string, total_tokens bigint, latency_ms bigint"
)
USERS = (
    "user_id string, user_tier string, platform string, signup_date timestamp_ntz, is_current boolean"
)
DAY = "2024-01-01"


def conv(spark, *rows):
    return spark.createDataFrame(
        [(str(i), t, u, ts, s, m, tok, lat) for i, (t, u, ts, s, m, tok, lat) in enumerate(rows)], CONV
    )


def api(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "user_id string, event_timestamp timestamp_ntz, http_status_code int, total_tokens bigint",
    )


def users(spark, *rows):
    return spark.createDataFrame(list(rows), USERS)


def msg(user, ts, session="s", model="m", tokens=10, latency=100):
    return ("message_sent", user, ts, session, model, tokens, latency)


def test_dau(spark):
    facts = conv(spark, msg("a", at(0)), msg("a", at(1)), msg("b", at(0)), msg("z", at(90_000)))
    calls = api(spark, ("a", at(5), 200, 1), ("c", at(5), 200, 1))
    dim = users(
        spark,
        ("a", "free", "ios", at(0), True),
        ("b", "plus", "web", at(-200_000), True),
        ("b", "free", "android", None, False),
    )
    row = metrics.daily_active_users(facts, calls, dim, DAY).first().asDict()
    assert row == {
        "total_dau": 3, "dau_free": 1, "dau_plus": 1, "dau_enterprise": 0, "dau_web": 1,
        "dau_mobile": 1, "dau_api": 2, "new_users_today": 1, "returning_users": 2,
        "event_date": datetime.date(2024, 1, 1),
    }


def test_quiet_day_gives_a_zero_row(spark):
    row = metrics.daily_active_users(conv(spark), api(spark), users(spark), DAY).first()
    assert row.total_dau == 0 and row.returning_users == 0


def test_two_current_rows_do_not_count_twice(spark):
    dim = users(spark, ("a", "free", "ios", None, True), ("a", "plus", "web", None, True))
    row = metrics.daily_active_users(conv(spark, msg("a", at(0))), api(spark), dim, DAY).first()
    assert (row.total_dau, row.dau_free, row.dau_plus) == (1, 1, 1)


def test_dau_needs_no_expand(spark):
    plan = plan_of(
        metrics.daily_active_users(conv(spark, msg("a", at(0))), api(spark), users(spark), DAY)
    )
    assert "Expand" not in plan


def test_weekly_engagement(spark):
    facts = conv(
        spark,
        msg("a", at(0), "s1", "m1", 10, 100),
        msg("a", at(1), "s1", "m2", 20, 300),
        msg("b", at(2), "s2", "m1", 30, 200),
        ("session_start", "a", at(3), "s9", "m9", None, None),
        msg("a", at(7 * 86_400), "s7", "m7", 99, 999),
    )
    dim = users(spark, ("a", "free", None, None, True))
    rows = {r.user_tier: r for r in metrics.weekly_engagement(facts, dim, "2024-01-04").collect()}
    free = rows["free"]
    assert free.week_start == datetime.date(2024, 1, 1)
    assert (free.total_sessions, free.total_messages, free.unique_models_used) == (1, 2, 2)
    assert (free.p50_latency_ms, free.p99_latency_ms) == (100, 300)
    assert free.avg_tokens_per_message == 15
    # Users without a dimension row are a tier of their own; the average is global.
    assert rows[None].total_messages == 1
    assert {r.avg_messages_per_session for r in rows.values()} == {1.5}


def test_sketch_percentiles_are_close(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 5000).alias("latency_ms"), F.lit(1).alias("g"))
    exact = metrics.latency_percentiles(df, ["g"]).first()
    rough = metrics.latency_percentiles(df, ["g"], accuracy=1000).first()
    for name in ("p50_latency_ms", "p95_latency_ms", "p99_latency_ms"):
        assert abs(exact[name] - rough[name]) <= 20


def billing(spark, *rows):
    return spark.createDataFrame(
        [(t, at(s), None if a is None else decimal.Decimal(a), p) for t, s, a, p in rows],
        "event_type string, event_timestamp timestamp_ntz, amount_usd decimal(18,2), "
        "payment_status string",
    )


def test_monthly_revenue(spark):
    df = billing(
        spark,
        ("subscription_created", 0, "20.00", None),
        ("payment_processed", 1, "5.50", "failed"),
        ("payment_processed", 2, "0.10", "succeeded"),
        ("refund", 3, "1.00", None),
        ("downgrade", 4, None, None),
        ("upgrade", 5, "60.00", None),
        ("refund", 20 * 86_400, "7.00", None),
    )
    row = metrics.monthly_revenue(df, "2024-01-10").first()
    assert row.month_start == datetime.date(2024, 1, 1)
    assert row.total_revenue_usd == decimal.Decimal("25.60")
    assert row.mrr_usd == decimal.Decimal("24.60")
    assert (row.churned_subscriptions, row.downgrades, row.upgrades, row.new_subscriptions) == (1, 1, 1, 1)
    strict = metrics.monthly_revenue(df, "2024-01-10", only_succeeded=True).first()
    assert strict.api_usage_revenue_usd == decimal.Decimal("0.10")
    assert metrics.monthly_revenue(df, "2023-12-10").first().total_revenue_usd == 0


def test_engagement_score_is_capped_and_joined_both_ways(spark):
    facts = conv(spark, *[msg("a", at(i), f"s{i}", f"m{i % 8}") for i in range(60)])
    calls = api(spark, *[("b", at(i), 200, 1) for i in range(10)], ("b", at(0), 500, 1))
    rows = {r.user_id: r for r in metrics.engagement_score(facts, calls).collect()}
    assert abs(rows["a"].engagement_score - 0.75) < 1e-9
    assert rows["b"].api_call_count == 10 and abs(rows["b"].engagement_score - 0.025) < 1e-9


def test_safety_dashboard(spark):
    safety = spark.createDataFrame(
        [("u", at(0), "prompt_injection", 0.5), ("u", at(100), "jailbreak_attempt", 0.7),
         ("v", at(90_000), "rate_limit_abuse", 0.1)],
        "user_id string, event_timestamp timestamp_ntz, violation_type string, confidence_score double",
    )
    held = spark.createDataFrame(
        [("u", at(60), True, None), ("u", at(60), False, "released"),
         ("w", at(60), False, "false_positive"), ("u", at(90_000), True, None)],
        "user_id string, quarantined_at timestamp_ntz, is_active boolean, review_outcome string",
    )
    row = metrics.safety_dashboard(safety, held, DAY, extended=True).first()
    assert (row.total_safety_signals, row.prompt_injection_attempts) == (2, 1)
    assert (row.accounts_quarantined, row.accounts_released) == (1, 1)
    assert abs(row.avg_confidence - 0.6) < 1e-9
    assert row.false_positive_rate == 0.5 and row.mean_time_to_detect_seconds == 60
    quiet = metrics.safety_dashboard(safety, held, "2020-01-01", extended=True).first()
    assert quiet.total_safety_signals == 0 and quiet.false_positive_rate is None


def test_enrichment(spark):
    df = spark.createDataFrame(
        [(c,) for c in (200, 201, 302, 400, 429, 499, 500, 599, 600, None)], "c int"
    )
    got = [r[0] for r in df.select(response_category(F.col("c"))).collect()]
    assert got == ["success", "unknown", "unknown", "client_error", "rate_limited", "client_error",
                   "server_error", "server_error", "unknown", "unknown"]

    calls = spark.createDataFrame(
        [("gpt-4o", 1_000_000, 100_000), ("o1-mini", 1_000_000, 0), (None, 5, 5)],
        "model_id string, input_tokens bigint, output_tokens bigint",
    )
    cost = token_cost(F.col("model_id"), F.col("input_tokens"), F.col("output_tokens"))
    assert [r[0] for r in calls.select(cost).collect()] == [3.5, 0.0, 0.0]
    priced = token_cost_from_dim(calls, dims.seed_models(spark))
    assert {r.model_id: r.estimated_cost_usd for r in priced.collect()} == {
        "gpt-4o": 3.5, "o1-mini": 3.0, None: 0.0,
    }

    kinds = spark.createDataFrame(
        [("upgrade", None), ("refund", None), ("downgrade", None), ("other", None),
         ("payment_processed", "failed"), ("payment_processed", None), (None, "failed")],
        "t string, s string",
    )
    out = kinds.select(revenue_impact(F.col("t")), requires_followup(F.col("t"), F.col("s"))).collect()
    assert [r[0] for r in out] == ["positive", "negative", "at_risk", "neutral", "positive", "positive",
                                   "neutral"]
    assert [r[1] for r in out] == [False, False, False, False, True, False, False]


def test_row_hash_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    one, two, three = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert one == three != two


def test_feeds(spark):
    runs = spark.createDataFrame(
        [("daily", at(i), "failed" if i % 2 else "success", float(i)) for i in range(30)],
        "job string, run_at timestamp_ntz, status string, duration_minutes double",
    )
    health = feeds.run_health(runs).first()
    assert (health.runs, health.success_rate, health.avg_duration_minutes) == (30, 0.5, 14.5)
    last = feeds.recent_failures(runs).collect()
    assert [r.duration_minutes for r in last] == [float(i) for i in range(29, 9, -2)]

    daily = spark.createDataFrame([("d1", 1, 5), ("d2", 4, 3)], "day string, a int, b int")
    delta = {(r.day, r.metric): r.delta for r in feeds.day_delta(daily, "day", ["a", "b"]).collect()}
    assert delta == {("d1", "a"): None, ("d2", "a"): 3, ("d1", "b"): None, ("d2", "b"): -2}
