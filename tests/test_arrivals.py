"""Late, early and repeated events: a load by arrival ends where one load of everything would."""

import datetime
import time

import pytest
from pyspark.sql import functions as F
from test_jobs import DAY1, DAY2, LINES, MIDNIGHT, bill, call, event, message, signal, signup, uid

from tidemark.operators.sessions import session_summary
from tidemark.plans import arrivals
from tidemark.plans.daily import run_day
from tidemark.sources import staging, topics
from tidemark.sources.warehouse import Warehouse

DAY4 = "2024-01-04"
H = 3600


def land(spark, root, topic, lines, writer):
    records = spark.createDataFrame([(x,) for x in lines], "value string")
    events = topics.flatten(topics.decode(records), topic)
    landed = staging.with_partitions(events).withColumn("_ingested_at", F.current_timestamp())
    staging.write_days(landed, root, topic, writer)


def stored(warehouse, table, schema="WAREHOUSE"):
    return {r.event_id: r for r in warehouse.read(table, schema).collect()}


@pytest.fixture()
def place(spark, tmp_path):
    return str(tmp_path / "staging"), Warehouse(spark, str(tmp_path / "warehouse"))


def test_daily_runs_take_in_what_came_late(spark, place):
    root, warehouse = place
    for topic, lines in LINES.items():
        land(spark, root, topic, lines, "first")
    ok = ("unique:event_id",)
    run_day(spark, root, warehouse, DAY1, ok)
    before = stored(warehouse, "FACT_CONVERSATIONS")
    # of the first day: a message that joins no session, one that moves the numbers of user 2, copies,
    # a copy under an event day of its own, and a change of a user that was never seen
    land(spark, root, "conversation_events", [
        message("late1", 5 * H, 1), message("late2", 100, 2), message("c2", 200, 2), message("c2", 200 + 2 * 24 * H, 2),
        message("late3", 13 * H, 9),
    ], "second")
    land(spark, root, "api_usage_events", [call("late4", 300, 1), call("a1", 100, 1)], "second")
    land(spark, root, "billing_events", [bill("late5", 400, 2, amount="7.00")], "second")
    land(spark, root, "safety_events", [signal("late6", 500, 2)], "second")
    land(spark, root, "user_events", [signup("late7", 50, 9)], "second")
    again = run_day(spark, root, warehouse, DAY2, ok)
    assert again["LATE_EVENTS"] == 6
    rows = stored(warehouse, "FACT_CONVERSATIONS")
    assert set(rows) == {"c1", "c2", "c3", "c4", "c5", "late1", "late2", "late3"}
    assert warehouse.read("FACT_CONVERSATIONS").count() == len(rows)
    number = {i: int(r.computed_session_id[-6:]) for i, r in rows.items()}
    assert number == {"c1": 1, "late1": 2, "c3": 3, "c4": 3, "late2": 1, "c2": 1, "late3": 1, "c5": 1}
    assert int(before["c3"].computed_session_id[-6:]) == 2  # renumbered since
    assert rows["late2"].user_sk and rows["c3"].user_sk == before["c3"].user_sk
    assert rows["late3"].user_sk and str(rows["late3"].dt) == DAY1
    assert set(stored(warehouse, "FACT_API_USAGE")) == {"a1", "a2", "a3", "late4"}
    assert "late6" in stored(warehouse, "SAFETY_EVENTS", "RAW")
    dau = {str(r.event_date): r.total_dau for r in warehouse.read("DAILY_ACTIVE_USERS", "CANONICAL").collect()}
    assert dau == {DAY1: 3, DAY2: 3}  # the first day again, with user 9
    week = warehouse.read("WEEKLY_ENGAGEMENT", "CANONICAL").agg(F.sum("total_messages")).first()[0]
    assert week == len(rows)
    revenue = warehouse.read("MONTHLY_REVENUE", "CANONICAL").first()
    assert float(revenue.mrr_usd) == 42.0
    # nothing new: nothing changes
    files = set(warehouse.read("FACT_CONVERSATIONS").where(F.col("dt") == DAY1).inputFiles())
    added, changed = arrivals.load_arrivals(spark, root, warehouse, before=DAY2)
    assert set(added.values()) == {0} and changed == []
    assert set(warehouse.read("FACT_CONVERSATIONS").where(F.col("dt") == DAY1).inputFiles()) == files


def test_a_day_without_run_is_made_up_for(spark, place):
    root, warehouse = place
    for topic, lines in LINES.items():
        land(spark, root, topic, lines, "first")
        more = {"conversation_events": message, "api_usage_events": call, "billing_events": bill, "user_events": signup, "safety_events": signal}
        land(spark, root, topic, [more[topic](f"d4{topic}", MIDNIGHT + 50 * H, 1)], "fourth")
    ok = ("unique:event_id",)
    run_day(spark, root, warehouse, DAY1, ok)
    rows = run_day(spark, root, warehouse, DAY4, ok)
    assert rows["LATE_EVENTS"] == 2 + 1 + 1 + 1
    assert {"c4", "c5", "d4conversation_events"} <= set(stored(warehouse, "FACT_CONVERSATIONS"))
    days, until = arrivals.loaded_days(warehouse, "api_usage_events")
    assert days == {DAY1, DAY2, DAY4} and until


def test_pruning_by_arrival(spark, place):
    root, warehouse = place
    land(spark, root, "api_usage_events", [call("a1", 100, 1)], "first")
    added, changed = arrivals.load_arrivals(spark, root, warehouse)
    assert added["FACT_API_USAGE"] == 1 and changed == [DAY1]
    time.sleep(1.1)
    began = arrivals.now_micros(spark)
    land(spark, root, "api_usage_events", [call("a2", 200, 1)], "second")
    late = staging.read_arrived(spark, root, "api_usage_events", began)
    assert [r.event_id for r in late.collect()] == ["a2"] and len(late.inputFiles()) == 1
    far = began + 3600 * 1_000_000
    assert staging.read_arrived(spark, root, "api_usage_events", far).count() == 0
    assert arrivals.load_arrivals(spark, root, warehouse, overlap_seconds=0)[0]["FACT_API_USAGE"] == 1
    assert arrivals.load_arrivals(spark, root, warehouse, overlap_seconds=0)[0]["FACT_API_USAGE"] == 0


def test_any_order_of_arrival_gives_the_same_sessions(spark, place):
    """Messages landed in four shuffled portions are numbered like all of them at once."""
    import random

    root, warehouse = place
    draw = random.Random(5)
    at = [(u, draw.randrange(0, 4 * 24 * H)) for u in range(6) for _ in range(40)]
    lines = [message(f"m{i}", s, u) for i, (u, s) in enumerate(at)]
    draw.shuffle(lines)
    for n in range(4):
        land(spark, root, "conversation_events", lines[n * 60 : n * 60 + 60] + lines[:5], f"part{n}")
        arrivals.load_arrivals(spark, root, warehouse)
    rows = warehouse.read("FACT_CONVERSATIONS")
    assert rows.count() == 240 and rows.select("event_id").distinct().count() == 240
    want = session_summary(rows.drop("computed_session_id"), timestamp_column="event_timestamp")
    got = rows.groupBy("user_id", "computed_session_id").agg(F.min("event_timestamp").alias("session_start"), F.count("*").alias("event_count"))
    same = ["user_id", "computed_session_id", "session_start", "event_count"]
    assert want.select(same).exceptAll(got.select(same)).isEmpty() and got.count() == want.count()
    assert rows.where(F.col("dt") != F.to_date("event_timestamp")).isEmpty()
    last = {r.user_id: r.last_session for r in warehouse.read_snapshot("SESSION_STATE", "9999-01-01").collect()}
    top = rows.groupBy("user_id").agg(F.max("computed_session_id").alias("s")).collect()
    assert last == {r.user_id: int(r.s[-6:]) for r in top}


def test_a_load_that_broke_off_is_repeated(spark, place, monkeypatch):
    root, warehouse = place
    land(spark, root, "conversation_events", [message("m1", 100, 1), message("m3", 9 * H, 1)], "first")
    arrivals.load_arrivals(spark, root, warehouse)
    land(spark, root, "conversation_events", [message("m2", 4 * H, 1)], "second")
    plain = arrivals.append_facts
    for broken in ("append_facts", "note_load"):
        def fail(*_, **__):
            raise RuntimeError("lost")

        monkeypatch.setattr(arrivals, broken, fail)
        with pytest.raises(RuntimeError):
            arrivals.load_arrivals(spark, root, warehouse)
        monkeypatch.undo()
    assert plain is arrivals.append_facts
    arrivals.load_arrivals(spark, root, warehouse)
    rows = stored(warehouse, "FACT_CONVERSATIONS")
    assert {i: int(r.computed_session_id[-6:]) for i, r in rows.items()} == {"m1": 1, "m2": 2, "m3": 3}
    assert warehouse.read("FACT_CONVERSATIONS").count() == 3
    state = warehouse.read_snapshot("SESSION_STATE", DAY1).collect()
    assert [(r.user_id, r.last_session) for r in state] == [(uid(1), 3)]


def test_reach():
    d = datetime.date(2024, 1, 10)
    assert arrivals._around([d], 1) == [d - datetime.timedelta(days=1), d, d + datetime.timedelta(days=1)]
    assert event("x", "y", 0, 1)
