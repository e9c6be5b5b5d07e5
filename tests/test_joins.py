import random

import pytest
from conftest import at, plan_of

from tidemark.operators.joins import (
    join_valid_at,
    merge_insert_if_absent,
    orphan_counts,
    resolve_keys,
)
from tidemark.plans.dims import calendar, seed_models, seed_plans

FACTS = "event_id string, user_id string, event_timestamp timestamp_ntz"
VERSIONS = (
    "user_id string, user_sk string, user_tier string, valid_from timestamp_ntz, "
    "valid_to timestamp_ntz"
)


@pytest.mark.parametrize("bucket_seconds", [300, 10**9])
def test_point_in_time_ties_and_placeless_facts(spark, bucket_seconds):
    versions = [
        ("u", "closed", "a", at(0), at(0)),  # held for no time
        ("u", "open", "a", at(0), None),
        ("u", "greater", "z", at(5000), None),
        ("u", "great", "z", at(5000), None),
        ("u", "timeless", "z", None, None),
        (None, "keyless", "z", at(0), None),
    ]
    facts = [("1", "u", at(0)), ("2", "u", at(4000)), ("3", "u", at(5000)), ("4", "u", at(90_000)),
             ("5", None, at(10)), ("6", "u", None), ("7", None, None), ("7", None, None)]
    for order in (versions, versions[::-1]):
        out = join_valid_at(
            spark.createDataFrame(facts, FACTS), spark.createDataFrame(order, VERSIONS),
            "user_id", "event_timestamp", ["user_sk"], bucket_seconds,
        )
        assert sorted((r.event_id, r.user_sk) for r in out.collect()) == [
            ("1", "open"), ("2", "open"), ("3", "greater"), ("4", "greater"),
            ("5", None), ("6", None), ("7", None), ("7", None),
        ]


@pytest.mark.parametrize("bucket_seconds", [300, 10**9])
def test_point_in_time_matches_brute_force(spark, bucket_seconds):
    dice = random.Random(3)
    versions = []
    for user in ("hot", "a", "b"):
        starts = sorted(dice.sample(range(0, 100_000), 12))
        ends = [*starts[1:], None]
        for i, (start, end) in enumerate(zip(starts, ends)):
            if i == 5:  # a hole: closed early, nothing valid until the next start
                end = start + 1
            versions.append((user, f"{user}{i}", f"t{i}", at(start), None if end is None else at(end)))
    edges = [v[3] for v in versions] + [v[4] for v in versions if v[4]]
    facts = [
        (str(i), dice.choice(["hot", "hot", "a", "b", "unknown"]), ts)
        for i, ts in enumerate([at(dice.randrange(-500, 110_000)) for _ in range(200)] + edges)
    ]
    facts.append(("none", None, at(5)))
    expected = {}
    for event_id, user, ts in facts:
        valid = [v for v in versions if v[0] == user and v[3] <= ts and (v[4] is None or ts < v[4])]
        expected[event_id] = valid[0][1] if valid else None
    out = join_valid_at(
        spark.createDataFrame(facts, FACTS),
        spark.createDataFrame(versions, VERSIONS),
        "user_id",
        "event_timestamp",
        ["user_sk", "user_tier"],
        bucket_seconds=bucket_seconds,
    )
    assert {r.event_id: r.user_sk for r in out.collect()} == expected
    assert out.columns == ["event_id", "user_id", "event_timestamp", "user_sk", "user_tier"]
    plan = plan_of(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_merge_leaves_existing_rows_alone(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int")
    merged = merge_insert_if_absent(target, source, "k")
    assert sorted(map(tuple, merged.collect())) == [("a", 1), ("b", 2)]
    again = merge_insert_if_absent(merged, source, "k")
    assert again.count() == 2


def test_seeds_merge_once(spark):
    models = seed_models(spark)
    assert models.count() == 6 and seed_models(spark, models).count() == 6
    plans = seed_plans(spark, "2024-01-01")
    assert plans.count() == 3
    later = seed_plans(spark, "2025-01-01", plans)
    assert {str(r.valid_from) for r in later.collect()} == {"2024-01-01"}


def test_surrogate_key_lookup(spark):
    facts = spark.createDataFrame(
        [("1", "u", at(0), "gpt-4o", "plan_plus"), ("2", "x", at(0), "other", None)],
        FACTS + ", model_id string, plan_id string",
    )
    users = spark.createDataFrame([("u", "sk", "free", at(-5), None)], VERSIONS)
    out = resolve_keys(
        facts, "event_timestamp", users, seed_models(spark), seed_plans(spark, "2024-01-01")
    )
    rows = {r.event_id: r for r in out.collect()}
    assert rows["1"].date_key == 20240101 and rows["1"].user_sk == "sk"
    assert rows["1"].model_sk and rows["1"].plan_sk
    assert rows["2"].user_sk is None and rows["2"].model_sk is None and rows["2"].plan_sk is None


def test_orphans_are_counted_per_key(spark):
    facts = spark.createDataFrame(
        [("1", "u", at(0)), ("2", "x", at(0)), ("3", "x", at(0)), ("4", None, at(0))], FACTS
    )
    users = spark.createDataFrame([("u",)], "user_id string")
    found = {r.user_id: r.fact_rows for r in orphan_counts(facts, users).collect()}
    assert found == {"x": 2, None: 1}


def test_calendar(spark):
    span = spark.sql("select date'2024-01-01' first_day, date'2024-12-31' last_day")
    days = {str(r.full_date): r for r in calendar(span).collect()}
    assert len(days) == 366
    holidays = sorted(d for d, r in days.items() if r.is_us_holiday)
    assert holidays == [
        "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-06-19", "2024-07-04",
        "2024-09-02", "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-25",
    ]
    saturday = days["2024-02-03"]
    assert saturday.is_weekend and saturday.day_of_week == 6 and saturday.date_key == 20240203
    assert saturday.day_name == "Saturday" and saturday.month_name == "February"
