"""Stored hours against the full scan, what an hour reads, and late signals."""

import math
import random

import pytest
from conftest import T0, at, plan_of
from pyspark.sql import functions as F

from tidemark.operators import moments
from tidemark.operators.anomalies import anomaly_summary, detect_zscore_anomalies
from tidemark.plans import hourly
from tidemark.sources.warehouse import Warehouse

H = 3600
SIGNALS = "event_id string, event_timestamp timestamp_ntz, user_id string, user_violation_count_30d bigint, violation_type string, severity string, confidence_score double"


def signals(spark, rows):
    made = [(f"s{i}", at(s), u, v, "jailbreak_attempt", "low", 0.1) for i, s, u, v in rows]
    return spark.createDataFrame(made, SIGNALS).withColumn("dt", F.to_date("event_timestamp"))


def calls(spark, rows):
    made = [(f"c{i}", at(s), u) for i, s, u in rows]
    df = spark.createDataFrame(made, "event_id string, event_timestamp timestamp_ntz, user_id string")
    return df.withColumn("dt", F.to_date("event_timestamp"))


@pytest.fixture()
def filled(spark, tmp_path):
    draw = random.Random(3)
    warehouse = Warehouse(spark, str(tmp_path))
    rows = [(i, draw.randrange(0, 60 * H), f"u{i % 7}", draw.randrange(1, 6)) for i in range(300)]
    rows += [(900 + i, 3 * H + i, f"u{i}", 400) for i in range(2)] + [(950, 30 * H, "u3", None), (951, 31 * H, None, 4)]
    warehouse.write(signals(spark, rows), "SAFETY_EVENTS", "RAW", "replace", ["dt"])
    used = [(i, draw.randrange(0, 60 * H), f"u{0 if i < 300 else i % 40}") for i in range(500)]
    warehouse.write(calls(spark, used), "FACT_API_USAGE", "WAREHOUSE", "replace", ["dt"])
    return warehouse


def until(warehouse, as_of):
    now = F.lit(as_of).cast("timestamp_ntz")
    read = lambda t, s: warehouse.read(t, s).where(F.col("event_timestamp") < now)
    return read("SAFETY_EVENTS", "RAW"), read("FACT_API_USAGE", "WAREHOUSE")


def test_increments_equal_the_full_scan(spark, filled):
    for as_of in ("2024-01-01 18:00:00", "2024-01-02 03:30:00", "2024-01-02 03:40:00", "2024-01-04 00:00:00"):
        hourly.handle_hours(filled, as_of)
        seen, used = until(filled, as_of[:14] + "00:00")
        want = {tuple(r) for r in moments.moments(seen, hourly.METRIC, ["user_id"]).collect()}
        assert {tuple(r) for r in hourly.window_moments(filled, as_of).collect()} == want
        want = {tuple(r) for r in used.groupBy("user_id").count().collect()}
        assert {tuple(r) for r in hourly.window_calls(filled, as_of).collect()} == want
    got = hourly.window_summary(filled, "2024-01-04 00:00:00").first()
    whole = anomaly_summary(*until(filled, "2024-01-04 00:00:00")).first()
    assert got.asDict() == whole.asDict() and got.behavioral == 2 and got.rate == 1


def test_an_hour_reads_one_hour(spark, filled):
    first = hourly.handle_hours(filled, "2024-01-02 03:00:00")
    assert len(first) == 30 * 24 + 3
    assert [str(h) for h in hourly.handle_hours(filled, "2024-01-02 04:10:00")] == ["2024-01-02 03:00:00"]
    assert hourly.handle_hours(filled, "2024-01-02 04:50:00") == []
    rows = hourly._rows_of(filled.read("SAFETY_EVENTS", "RAW"), [T0.replace(day=2, hour=3)])
    plan = plan_of(rows)
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters: [IsNotNull(event_timestamp), GreaterThanOrEqual" in plan
    assert {r.event_timestamp.hour for r in rows.collect()} <= {3}


def test_changed_hours_are_handled_again(spark, filled):
    hourly.handle_hours(filled, "2024-01-03 00:00:00")
    late = signals(spark, [(990, 5 * H, "u5", 500)])
    filled.write(late, "SAFETY_EVENTS", "RAW", "append", ["dt"])
    hour = T0.replace(hour=15)
    hourly.note_hours(filled, [hour], False)
    assert hourly.handle_hours(filled, "2024-01-03 00:00:00") == [hour]
    seen, _ = until(filled, "2024-01-03 00:00:00")
    want = {tuple(r) for r in moments.moments(seen, hourly.METRIC, ["user_id"]).collect()}
    assert {tuple(r) for r in hourly.window_moments(filled, "2024-01-03 00:00:00").collect()} == want
    assert "s990" in {r.event_id for r in filled.read(hourly.FLAGGED, "SAFETY").collect()}


def test_leave_one_out(spark):
    values = [3] * 6 + [9] + [None]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", v) for v in (1, 2, 3, 4, 5, 50)], "user_id string, x int")
    got = detect_zscore_anomalies(df, "x", leave_one_out=True).collect()
    by = {(r.user_id, r.x): (r.anomaly_zscore, r.is_anomaly) for r in got}
    # the others of 9 are all equal: no spread, no score; with itself it has one
    assert by["a", 9] == (0.0, False) and by["a", None] == (0.0, False)
    others = [1, 2, 3, 4, 5]
    mean, sd = 3.0, math.sqrt(sum((v - 3) ** 2 for v in others) / 4)
    assert by["b", 50] == (pytest.approx((50 - mean) / sd), True)
    plain = {(r.user_id, r.x): r.is_anomaly for r in detect_zscore_anomalies(df, "x").collect()}
    assert not plain["b", 50]  # six rows can't pass 3 with their own value in the baseline


def test_zscore_reads_its_input_twice(spark, filled):
    scored = detect_zscore_anomalies(filled.read("SAFETY_EVENTS", "RAW"), hourly.METRIC)
    assert plan_of(scored).count("FileScan parquet") == 2
