"""The daily and hourly jobs over a small staging area, run twice."""

import json

import pytest
from conftest import at
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityGateFailed
from tidemark.plans.daily import run_day
from tidemark.plans.dims import read_users
from tidemark.plans.hourly import run_hour
from tidemark.sources import staging, topics
from tidemark.sources.warehouse import Warehouse

DAY1, DAY2 = "2024-01-01", "2024-01-02"
MIDNIGHT = 14 * 3600  # seconds after at(0)


def uid(n):
    return f"usr_{n:016d}"


def event(event_id, kind, seconds, user, **payload):
    return json.dumps(
        {"event_id": event_id, "event_type": kind, "timestamp": at(seconds).isoformat(),
         "user_id": uid(user), "payload": payload}
    )


def signup(event_id, seconds, user):
    return event(event_id, "user_signup", seconds, user, display_name=f"U{user}", country_code="US",
                 user_tier="free", platform="ios", email_hash="h")


def message(event_id, seconds, user):
    return event(event_id, "message_sent", seconds, user, session_id=f"s{user}", model_id="gpt-4o",
                 input_tokens=10, output_tokens=20, total_tokens=30, latency_ms=100,
                 message_role="user")


def call(event_id, seconds, user, status=200):
    return event(event_id, "api_call", seconds, user, model_id="gpt-4o", http_status_code=status,
                 input_tokens=1000, output_tokens=0, total_tokens=1000, latency_ms=5)


def signal(event_id, seconds, user, severity="low", confidence=0.5, count=1):
    return event(event_id, "safety_signal", seconds, user, violation_type="jailbreak_attempt",
                 severity=severity, confidence_score=confidence, user_violation_count_30d=count)


def bill(event_id, seconds, user, kind="subscription_created", amount="20.00"):
    return event(event_id, kind, seconds, user, plan_id="plan_plus", amount_usd=amount)


LINES = {
    "user_events": [
        signup("u1", 10, 1), signup("u2", 20, 2), signup("u3", MIDNIGHT + 5, 3),
        event("u4", "user_tier_change", MIDNIGHT + 60, 1, old_tier="free", new_tier="plus"),
    ],
    "conversation_events": [
        message("c1", 100, 1), message("c1", 101, 1), message("c2", 200, 2),
        # A session across midnight, and a copy that arrived on the next day.
        message("c3", MIDNIGHT - 60, 1), message("c3", MIDNIGHT + 1, 1),
        message("c4", MIDNIGHT + 120, 1), message("c5", MIDNIGHT + 9000, 3),
    ],
    "api_usage_events": [call("a1", 100, 1), call("a2", 120, 2, 429), call("a3", MIDNIGHT + 1, 2)],
    "billing_events": [
        bill("b1", 100, 1), bill("b2", 200, 2, "refund", "5.00"), bill("b3", MIDNIGHT + 10, 3),
    ],
    "safety_events": [
        *[signal(f"s{i}", 300 + i, 1) for i in range(20)],
        signal("s20", 400, 1, "critical", 0.9, 500),
        signal("s21", MIDNIGHT + 400, 2),
    ],
}


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("staging"))
    for topic, lines in LINES.items():
        records = spark.createDataFrame([(x,) for x in lines], "value string")
        events = topics.flatten(topics.decode(records), topic)
        landed = staging.with_partitions(events).withColumn("_ingested_at", F.current_timestamp())
        staging.write_days(landed, root, topic)
    return root


@pytest.fixture(scope="module")
def warehouse(spark, staged, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    with pytest.raises(QualityGateFailed, match="unique:event_id"):
        run_day(spark, staged, warehouse, DAY1)
    rows = [
        run_day(spark, staged, warehouse, day, tolerate=("unique:event_id",))
        for day in (DAY1, DAY2, DAY2)  # the second day twice
    ]
    names = ["FACT_CONVERSATIONS", "FACT_API_USAGE", "FACT_BILLING", "SAFETY_EVENTS"]
    assert [rows[0][n] for n in names] == [3, 2, 2, 21]
    assert [rows[1][n] for n in names] == [2, 1, 1, 1] and rows[2] == rows[1]
    return warehouse


def test_facts_hold_each_event_once_with_keys(spark, warehouse):
    rows = {r.event_id: r for r in warehouse.read("FACT_CONVERSATIONS").collect()}
    assert warehouse.read("FACT_CONVERSATIONS").count() == len(rows) == 5
    assert str(rows["c3"].dt) == DAY1 and rows["c4"].date_key == 20240102
    assert all(r.user_sk and r.model_sk and r._loaded_at for r in rows.values())
    # The session of user 1 goes on over midnight, also on a rerun.
    assert rows["c3"].computed_session_id == rows["c4"].computed_session_id
    assert rows["c4"].computed_session_id == f"{uid(1)}_sess_000002"
    assert rows["c5"].computed_session_id == f"{uid(3)}_sess_000001"
    assert warehouse.read("FACT_API_USAGE").count() == 3
    assert warehouse.read("FACT_BILLING").where("plan_sk is not null").count() == 3
    costs = {r.event_id: r.estimated_cost_usd for r in warehouse.read("FACT_API_USAGE").collect()}
    assert costs["a1"] == 0.0025


def test_user_dimension_has_one_current_version_each(spark, warehouse):
    users = read_users(warehouse, DAY2)
    current = {r.user_id: r.user_tier for r in users.where("is_current").collect()}
    assert current == {uid(1): "plus", uid(2): "free", uid(3): "free"}
    assert users.count() == 4
    earlier = read_users(warehouse, DAY1)
    assert earlier.count() == 2


def test_fact_points_to_the_version_of_its_time(spark, warehouse):
    facts = warehouse.read("FACT_CONVERSATIONS")
    users = read_users(warehouse, DAY2).select("user_sk", "user_tier")
    tiers = {r.event_id: r.user_tier for r in facts.join(users, "user_sk").collect()}
    assert (tiers["c1"], tiers["c3"], tiers["c4"]) == ("free", "free", "plus")


def test_canonical_tables_have_one_row_per_period(spark, warehouse):
    dau = {str(r.event_date): r for r in warehouse.read("DAILY_ACTIVE_USERS", "CANONICAL").collect()}
    assert warehouse.read("DAILY_ACTIVE_USERS", "CANONICAL").count() == 2
    assert (dau[DAY1].total_dau, dau[DAY1].new_users_today) == (2, 2)
    assert (dau[DAY2].total_dau, dau[DAY2].new_users_today, dau[DAY2].dau_plus) == (3, 1, 1)
    revenue = warehouse.read("MONTHLY_REVENUE", "CANONICAL").collect()
    assert [float(r.mrr_usd) for r in revenue] == [35.0]
    weeks = warehouse.read("WEEKLY_ENGAGEMENT", "CANONICAL").collect()
    assert {r.user_tier: r.total_messages for r in weeks} == {"plus": 3, "free": 2}
    assert warehouse.read("DIM_TIME").count() == 366


def test_hourly_run_quarantines_once(spark, warehouse):
    first = run_hour(spark, warehouse, "2024-01-01 18:00:00")
    again = run_hour(spark, warehouse, "2024-01-01 19:00:00")
    assert first["behavioral"] == 1 and first["anomaly_count"] >= 1
    assert again == first
    held = warehouse.read("QUARANTINED_ACCOUNTS", "SAFETY").collect()
    assert [r.user_id for r in held] == [uid(1)]
    board = warehouse.read("SAFETY_DASHBOARD", "SAFETY").collect()
    assert [(r.total_safety_signals, r.accounts_quarantined) for r in board] == [(21, 1)]
    # The z-score of the outlier needs its user's other 20 signals.
    quiet = run_hour(spark, warehouse, "2024-03-15 00:00:00")
    assert quiet["anomaly_count"] == 0


def test_no_changes_leave_the_last_snapshot(spark, warehouse):
    assert [day for _, day in warehouse.partitions("DIM_USERS")] == [DAY1, DAY2]
    assert read_users(warehouse, "2024-01-09").count() == 4


def test_closed_versions_are_written_once(spark, warehouse):
    """A batch reads and writes heads; what it closed is in its own partition."""
    heads = warehouse.read_snapshot("DIM_USERS", DAY2)
    assert heads.count() == heads.select("user_id").distinct().count() == 3
    closed = warehouse.read("DIM_USERS_CLOSED")
    assert [(r.user_id, str(r.closed_on), r.user_tier) for r in closed.collect()] == [(uid(1), DAY2, "free")]
