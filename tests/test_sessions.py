import datetime

from conftest import at, plan_of
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators.sessions import session_gaps, session_state, session_summary, sessionize

SCHEMA = "event_id string, user_id string, timestamp timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame(
        [(str(i), user, at(s)) for i, (user, s) in enumerate(rows)], SCHEMA
    )


def ids(df):
    return {r.event_id: r.computed_session_id for r in df.collect()}


def whole(seconds):
    return int(at(seconds).replace(tzinfo=datetime.timezone.utc).timestamp() // 1)


def brute(rows, gap_seconds):
    """Session ids by walking each user's events in order."""
    out = {}
    for user in {u for u, _ in rows}:
        mine = sorted((s, i) for i, (u, s) in enumerate(rows) if u == user)
        number, last = 0, None
        for s, i in mine:
            if last is None or whole(s) - last > gap_seconds:
                number += 1
            last = whole(s)
            out[str(i)] = f"{user}_sess_{number:06d}"
    return out


def test_gap_opens_a_session(spark):
    out = ids(sessionize(frame(spark, [("u", 0), ("u", 600), ("u", 3600)])))
    assert out == {"0": "u_sess_000001", "1": "u_sess_000001", "2": "u_sess_000002"}


def test_gap_equal_to_the_limit_stays(spark):
    assert len(set(ids(sessionize(frame(spark, [("u", 0), ("u", 1800)]))).values())) == 1
    assert len(set(ids(sessionize(frame(spark, [("u", 0), ("u", 1801)]))).values())) == 2


def test_other_limits(spark):
    rows = [("u", 0), ("u", 360)]
    assert len(set(ids(sessionize(frame(spark, rows), gap_minutes=5)).values())) == 2
    assert len(set(ids(sessionize(frame(spark, rows), gap_minutes=10)).values())) == 1


def test_users_are_separate(spark):
    out = ids(sessionize(frame(spark, [("a", 0), ("b", 1)])))
    assert out == {"0": "a_sess_000001", "1": "b_sess_000001"}


def test_rows_without_user_or_time_are_kept(spark):
    df = spark.createDataFrame([("1", None, at(0)), ("2", "u", None), ("3", "u", at(0))], SCHEMA)
    out = ids(sessionize(df))
    assert len(out) == 3 and out["3"] == "u_sess_000001"


def test_iso_text_with_offset(spark):
    df = spark.createDataFrame(
        [("1", "u", "2026-01-01T10:00:00+00:00"), ("2", "u", "2026-01-01T10:10:00+00:00")],
        "event_id string, user_id string, timestamp string",
    )
    for form in (df, df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))):
        assert set(ids(sessionize(form)).values()) == {"u_sess_000001"}


MANY = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40_000).map(lambda x: x / 4)),
    min_size=1,
    max_size=40,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=MANY, minutes=st.sampled_from([0, 1, 5, 30]))
def test_matches_brute_force(spark, rows, minutes):
    got = ids(sessionize(frame(spark, rows), gap_minutes=minutes))
    assert got == brute(rows, minutes * 60)


def test_summary_agrees_with_rows(spark):
    rows = [("a", s * 700) for s in range(10)] + [("a", 50_000 + s * 4000) for s in range(5)]
    df = frame(spark, rows)
    by_rows = (
        sessionize(df)
        .groupBy("computed_session_id")
        .agg(F.min("timestamp"), F.max("timestamp"), F.count("*"))
    )
    summary = session_summary(df).select(
        "computed_session_id", "session_start", "session_end", "event_count"
    )
    assert sorted(map(tuple, by_rows.collect())) == sorted(map(tuple, summary.collect()))


def test_carry_continues_sessions_and_numbers(spark):
    rows = [("a", 0), ("a", 5000), ("a", 6000), ("a", 10_000), ("b", 0), ("c", 6500)]
    whole_run = ids(sessionize(frame(spark, rows)))
    df = frame(spark, rows)
    first = sessionize(df.where(F.col("timestamp") < at(5500)))
    state = session_state(first)
    second = sessionize(df.where(F.col("timestamp") >= at(5500)), carry=state)
    assert {**ids(first), **ids(second)} == whole_run
    final = {r.user_id: r.last_session for r in session_state(second, state).collect()}
    assert final == {"a": 3, "b": 1, "c": 1}


def test_gaps_match_lag(spark):
    rows = [("a", s) for s in (0, 0.25, 0.5, 3, 90_000, 90_000, 200_000)] + [("b", 7)]
    got = {r.event_id: r.gap_seconds for r in session_gaps(frame(spark, rows)).collect()}
    expected = {
        "0": None, "1": 0, "2": 0, "3": 3, "4": 89_997, "5": 0, "6": 110_000, "7": None,
    }
    assert got == expected


def test_no_window_over_raw_events_of_a_user(spark):
    """Windows run over pre-aggregated (user, bucket) rows only."""
    plan = plan_of(sessionize(frame(spark, [("u", 0)])))
    below = plan[plan.index("Window") :]
    assert "HashAggregate(keys=[user_id" in below
