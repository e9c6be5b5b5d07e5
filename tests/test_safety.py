import math
import statistics

import pytest
from conftest import at, plan_of

from tidemark.operators import anomalies
from tidemark.operators.quarantine import quarantine_candidates

SIGNALS = (
    "event_id string, user_id string, event_timestamp timestamp_ntz, violation_type string, "
    "severity string, confidence_score double, user_violation_count_30d bigint"
)


def metric(spark, values, user="u"):
    rows = [(str(i), user, at(i), "t", "low", 0.5, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SIGNALS)


def scores(df):
    out = anomalies.detect_zscore_anomalies(df, "user_violation_count_30d")
    return {int(r.event_id): r for r in out.collect()}


def test_zscore_formula(spark):
    values = [1] * 20 + [50]
    mean, sd = statistics.mean(values), statistics.stdev(values)
    out = scores(metric(spark, values))
    assert out[20].anomaly_zscore == pytest.approx(abs(50 - mean) / sd)
    assert out[20].is_anomaly and not out[0].is_anomaly


def test_small_or_flat_groups_score_zero(spark):
    assert {r.anomaly_zscore for r in scores(metric(spark, [1, 2, 3, 100])).values()} == {0.0}
    assert {r.anomaly_zscore for r in scores(metric(spark, [7] * 9)).values()} == {0.0}


def test_ten_rows_cannot_pass_three(spark):
    out = scores(metric(spark, [1, 2, 1, 2, 1, 2, 1, 2, 1, 10_000]))
    assert max(r.anomaly_zscore for r in out.values()) <= 9 / math.sqrt(10) + 1e-9
    assert not any(r.is_anomaly for r in out.values())


def calls(spark, counts):
    rows = [(u, at(i)) for u, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "user_id string, event_timestamp timestamp_ntz")


def test_rate_anomalies(spark):
    counts = {f"u{i}": 2 for i in range(60)} | {"loud": 300}
    out = {r.user_id: r for r in anomalies.detect_rate_anomalies(calls(spark, counts)).collect()}
    assert out["loud"].is_rate_anomaly and out["loud"].request_count == 300
    assert sum(r.is_rate_anomaly for r in out.values()) == 1


def test_equal_rates_use_a_spread_of_one(spark):
    out = anomalies.detect_rate_anomalies(calls(spark, {"a": 3, "b": 3})).collect()
    assert not any(r.is_rate_anomaly for r in out)
    single = anomalies.detect_rate_anomalies(calls(spark, {"a": 9})).collect()
    assert not single[0].is_rate_anomaly


def test_rates_need_no_cross_join(spark):
    plan = plan_of(anomalies.detect_rate_anomalies(calls(spark, {"a": 1})))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Subquery" in plan


def test_windowed_rates(spark):
    rows = [("a", at(60 * m)) for m in range(5)] + [("a", at(3700)), ("b", at(0))]
    df = spark.createDataFrame(rows, "user_id string, event_timestamp timestamp_ntz")
    out = {
        (r.user_id, r.window_start): r.request_count
        for r in anomalies.detect_rate_anomalies(df, window_minutes=60).collect()
    }
    assert out == {("a", at(0)): 5, ("a", at(3600)): 1, ("b", at(0)): 1}


def test_summary_of_nothing_is_zero(spark):
    empty = metric(spark, [])
    row = anomalies.anomaly_summary(empty, calls(spark, {})).first()
    assert (row.behavioral, row.rate, row.anomaly_count) == (0, 0, 0)


def signals(spark, *rows):
    return spark.createDataFrame(
        [(str(i), u, at(ts), v, s, c, 1) for i, (u, ts, v, s, c) in enumerate(rows)], SIGNALS
    )


NOW = "2024-01-02 00:00:00"


def chosen(df, **more):
    return {r.user_id: r for r in quarantine_candidates(df, NOW, **more).collect()}


def test_quarantine_rules(spark):
    df = signals(
        spark,
        *[("five", i, "x", "high", 0.1) for i in range(5)],
        *[("four", i, "x", "high", 0.1) for i in range(4)],
        ("sure", 0, "b", "critical", 0.7),
        ("sure", 1, "a", "low", 0.2),
        ("unsure", 0, "b", "critical", 0.69),
        # Confidence and severity must meet in one signal.
        ("unsure", 1, "b", "low", 0.99),
    )
    out = chosen(df)
    assert set(out) == {"five", "sure"}
    row = out["sure"]
    assert (row.severity, row.violation_count, row.violation_type) == ("critical", 2, "a")
    assert row.confidence_score == 0.7 and row.is_active and row.reviewed_at is None
    assert row.quarantine_reason.startswith("held after")


def test_lookback_and_active_accounts(spark):
    old = -40 * 86_400
    df = signals(
        spark,
        ("old", old, "b", "critical", 0.9),
        ("held", 0, "b", "critical", 0.9),
        ("freed", 0, "b", "critical", 0.9),
        ("future", 200_000, "b", "critical", 0.9),
    )
    held = spark.createDataFrame(
        [("held", True), ("freed", False)], "user_id string, is_active boolean"
    )
    assert set(chosen(df, active=held)) == {"freed"}


def test_signals_before_a_review_do_not_count_again(spark):
    df = signals(
        spark,
        ("freed", 0, "b", "critical", 0.9),
        ("again", 0, "b", "critical", 0.9),
        ("again", 7200, "b", "critical", 0.9),
        ("unknown", 0, "b", "critical", 0.9),
        (None, 0, "b", "critical", 0.9),
    )
    rows = [("freed", False, at(3600)), ("again", False, at(3600)), ("again", False, at(60)),
            ("unknown", False, None), (None, False, at(3600))]
    held = spark.createDataFrame(rows, "user_id string, is_active boolean, reviewed_at timestamp_ntz")
    found = chosen(df, active=held)
    assert set(found) == {"again", "unknown", None}
    assert found["again"].violation_count == 1


def test_primary_type_is_the_most_frequent(spark):
    df = signals(
        spark,
        ("u", 0, "zzz", "critical", 0.9),
        ("u", 1, "mmm", "low", 0.9),
        ("u", 2, "mmm", "low", 0.9),
    )
    assert chosen(df)["u"].violation_type == "mmm"
