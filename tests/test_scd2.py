import os
import random

import pytest
from conftest import at
from pyspark.sql import functions as F

from tidemark.operators.scd2 import (
    apply_scd_type2,
    empty_dimension,
    keys_with_many_current,
    late_changes,
    merge_heads,
    split_versions,
)
from tidemark.plans.dims import merge_users, read_users, store_users, user_changes
from tidemark.sources.warehouse import Warehouse

ATTRIBUTES = ["user_tier", "country_code", "organization_id"]
TRACKED = ["user_tier", "country_code"]
DIM = (
    "user_id string, user_tier string, country_code string, organization_id string, "
    "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
)
INCOMING = (
    "user_id string, user_tier string, country_code string, organization_id string, "
    "changed_at timestamp_ntz"
)


def dim(spark, *rows):
    return spark.createDataFrame(list(rows), DIM)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), INCOMING)


@pytest.fixture(params=[900, 10**9])
def merge(request):
    """Buckets of 15 minutes, and buckets that hold a key's whole timeline."""
    return lambda existing, incoming: apply_scd_type2(
        existing, incoming, "user_id", TRACKED, effective_column="changed_at", bucket_seconds=request.param
    )


def rows_of(df):
    return sorted(
        (r.user_id, r.valid_from, r.valid_to, r.is_current, r.user_tier, r.country_code, r.change_kind)
        for r in df.collect()
    )


def test_same_instant_winner_that_repeats_the_state_opens_nothing(spark, merge):
    existing = dim(spark, ("u1", "b", "US", None, at(0), None, True), ("u2", "b", "US", None, at(0), None, True))
    both = [(user, tier, "US", None, at(10)) for user in ("u1", "u2") for tier in ("a", "b")]
    incoming = batch(spark, *both, ("u2", "c", "US", None, at(2000)))
    winner = incoming.withColumn("tie", F.xxhash64(*ATTRIBUTES)).where("user_id = 'u1'").orderBy("tie").collect()[-1]
    got = [r for r in rows_of(merge(existing, incoming)) if r[0] == "u1"]
    if winner.user_tier == "b":
        assert got == [("u1", at(0), None, True, "b", "US", "unchanged")]
    else:
        assert [r[1:5] for r in got] == [(at(0), at(10), False, "b"), (at(10), None, True, "a")]
    chain = [r for r in rows_of(merge(existing, incoming)) if r[0] == "u2"]
    assert all(a[4:6] != b[4:6] for a, b in zip(chain, chain[1:]))
    assert all(a[2] == b[1] for a, b in zip(chain, chain[1:]))


def test_changes_without_key_or_time_are_set_apart(spark, merge):
    existing = dim(spark, ("u1", "free", "US", None, at(0), None, True))
    incoming = batch(
        spark, ("u1", "plus", "US", None, at(10)), (None, "plus", "US", None, at(10)), ("u1", "pro", "US", None, None)
    )
    assert rows_of(merge(existing, incoming)) == [
        ("u1", at(0), at(10), False, "free", "US", "expired"),
        ("u1", at(10), None, True, "plus", "US", "new_version"),
    ]
    apart = late_changes(existing, incoming, "user_id", "changed_at").collect()
    assert sorted(r.user_tier for r in apart) == ["plus", "pro"]


def test_new_keys_open_versions(spark, merge):
    incoming = batch(spark, ("u1", "free", "US", None, at(0)), ("u2", "plus", "DE", None, at(0)))
    out = merge(empty_dimension(incoming, "changed_at"), incoming)
    assert out.count() == 2 and out.where("is_current").count() == 2
    assert {r.change_kind for r in out.collect()} == {"new_key"}


def test_unchanged_rows_stay_single(spark, merge):
    existing = dim(spark, ("u1", "free", "US", None, at(0), None, True))
    out = merge(existing, batch(spark, ("u1", "free", "US", "org", at(10))))
    assert rows_of(out) == [("u1", at(0), None, True, "free", "US", "unchanged")]


def test_change_closes_and_opens(spark, merge):
    existing = dim(spark, ("u1", "free", "US", None, at(0), None, True))
    out = merge(existing, batch(spark, ("u1", "plus", "US", None, at(10))))
    assert rows_of(out) == [
        ("u1", at(0), at(10), False, "free", "US", "expired"),
        ("u1", at(10), None, True, "plus", "US", "new_version"),
    ]


def test_closed_history_of_batch_keys_survives(spark, merge):
    existing = dim(
        spark,
        ("u1", "plus", "US", None, at(-100), at(0), False),
        ("u1", "free", "US", None, at(0), None, True),
        ("gone", "free", "US", None, at(-100), at(-50), False),
        ("idle", "free", "US", None, at(0), None, True),
    )
    out = merge(existing, batch(spark, ("u1", "plus", "US", None, at(10))))
    kinds = sorted((r.user_id, r.change_kind) for r in out.collect())
    assert kinds == [
        ("gone", "history"),
        ("idle", "untouched"),
        ("u1", "expired"),
        ("u1", "history"),
        ("u1", "new_version"),
    ]


def test_reopened_key_gets_a_new_version(spark, merge):
    existing = dim(spark, ("u1", "free", "US", None, at(-100), at(-50), False))
    out = merge(existing, batch(spark, ("u1", "free", "US", None, at(10))))
    assert [r.change_kind for r in out.orderBy("valid_from").collect()] == ["history", "new_version"]


def test_several_changes_form_a_chain_with_one_current(spark, merge):
    incoming = batch(
        spark,
        ("u1", "free", "US", None, at(0)),
        ("u1", "plus", None, None, at(10)),
        ("u1", "plus", "US", None, at(20)),
        ("u1", "free", None, None, at(50_000)),
    )
    out = merge(empty_dimension(incoming, "changed_at"), incoming)
    assert [(r[1], r[2], r[4], r[5]) for r in rows_of(out)] == [
        (at(0), at(10), "free", "US"),
        (at(10), at(50_000), "plus", "US"),
        (at(50_000), None, "free", "US"),
    ]
    assert keys_with_many_current(out, "user_id").isEmpty()


def test_null_attributes_are_carried_from_the_open_version(spark, merge):
    existing = dim(spark, ("u1", "free", "US", "org", at(0), None, True))
    out = merge(existing, batch(spark, ("u1", "plus", None, None, at(10)))).where("is_current")
    row = out.first()
    assert (row.user_tier, row.country_code, row.organization_id) == ("plus", "US", "org")


def test_late_changes_are_reported_not_applied(spark, merge):
    existing = dim(spark, ("u1", "free", "US", None, at(100), None, True))
    incoming = batch(
        spark, ("u1", "plus", "US", None, at(50)), ("u1", "enterprise", "US", None, at(150))
    )
    late = late_changes(existing, incoming, "user_id", "changed_at")
    assert [r.user_tier for r in late.collect()] == ["plus"]
    assert late.columns == incoming.columns
    assert "plus" not in {r.user_tier for r in merge(existing, incoming).collect()}


def test_rerun_of_a_batch_changes_nothing(spark, merge):
    existing = dim(spark, ("u1", "free", "US", None, at(0), None, True))
    incoming = batch(spark, ("u1", "plus", "US", None, at(10)), ("u2", "free", "DE", None, at(5)))
    once = merge(existing, incoming)
    again = merge(once.drop("change_kind"), incoming)
    key = ["user_sk", "user_id", "user_tier", "valid_from", "valid_to", "is_current"]
    assert sorted(once.select(key).collect(), key=repr) == sorted(again.select(key).collect(), key=repr)


def test_same_instant_keeps_one_version(spark, merge):
    incoming = batch(spark, ("u1", "free", "US", None, at(0)), ("u1", "plus", "US", None, at(0)))
    out = merge(empty_dimension(incoming, "changed_at"), incoming)
    assert out.count() == 1 and out.first().is_current


def chain_by_hand(existing, incoming):
    """Versions (key, from, to, tier, country) by walking each key in time order."""
    out = []
    keys = {r[0] for r in existing} | {r[0] for r in incoming}
    for key in keys:
        mine = [list(r) for r in existing if r[0] == key]
        versions = [(r[4], r[1], r[2]) for r in mine]
        state = versions[-1][1:] if versions else None
        for _, tier, country, _, ts in sorted((r for r in incoming if r[0] == key), key=lambda r: r[4]):
            if versions and ts <= versions[0][0] and mine:
                continue
            new = (tier or (state and state[0]), country or (state and state[1]))
            if state is None or new != state:
                versions.append((ts, *new))
            state = new
        for i, (start, tier, country) in enumerate(versions):
            end = versions[i + 1][0] if i + 1 < len(versions) else None
            out.append((key, start, end, tier, country))
    return sorted(out, key=repr)


def test_matches_brute_force_with_a_hot_key(spark, merge):
    dice = random.Random(7)
    keys = ["hot"] * 5 + [f"k{i}" for i in range(10)]
    existing = [(f"k{i}", "free", "US", None, at(0), None, True) for i in range(6)]
    incoming = [
        (
            dice.choice(keys),
            dice.choice(["free", "plus", None]),
            dice.choice(["US", "DE", None, None]),
            None,
            at(second - 100),
        )
        for second in dice.sample(range(60_000), 300)
    ]
    out = merge(dim(spark, *existing), batch(spark, *incoming))
    got = sorted(
        ((r.user_id, r.valid_from, r.valid_to, r.user_tier, r.country_code) for r in out.collect()),
        key=repr,
    )
    assert got == chain_by_hand(existing, incoming)


def test_user_changes_take_the_new_tier_and_carry_the_rest(spark):
    rows = [
        ("e1", "user_signup", at(0), "u1", "h", "Ann", "US", "free", "web", None, None),
        ("e2", "user_tier_change", at(60), "u1", None, None, None, None, None, None, "plus"),
        ("e2", "user_tier_change", at(61), "u1", None, None, None, None, None, None, "plus"),
        ("e3", "user_login", at(70), "u1", None, None, "FR", None, "ios", None, None),
    ]
    events = spark.createDataFrame(
        rows,
        "event_id string, event_type string, timestamp timestamp_ntz, user_id string, "
        "email_hash string, display_name string, country_code string, user_tier string, "
        "platform string, organization_id string, new_tier string",
    )
    changes = user_changes(events)
    assert changes.count() == 2
    current = merge_users(None, changes).where("is_current").first()
    assert (current.user_tier, current.country_code, current.account_status) == ("plus", "US", "active")
    assert current.signup_date == at(0) and current.valid_from == at(61)


def test_batch_without_times_takes_effect_as_a_whole(spark):
    existing = dim(spark, ("u1", "free", "US", None, at(0), None, True)).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in ("valid_from", "valid_to")}
    )
    incoming = batch(spark, ("u1", "plus", "US", None, None), ("u2", "free", "DE", None, None))
    out = apply_scd_type2(
        existing, incoming.drop("changed_at"), "user_id", TRACKED, as_of="2024-01-01 12:00:00"
    )
    assert [r[:5] for r in rows_of(out)] == [
        ("u1", at(0), at(7200), False, "free"),
        ("u1", at(7200), None, True, "plus"),
        ("u2", at(7200), None, True, "free"),
    ]
    with pytest.raises(ValueError):
        apply_scd_type2(existing, incoming.drop("changed_at"), "user_id", TRACKED)


def test_surrogate_keys_are_unique(spark, merge):
    incoming = batch(
        spark, *[("u1", t, "US", None, at(i * 7)) for i, t in enumerate(["free", "plus"] * 5)]
    )
    out = merge(empty_dimension(incoming, "changed_at"), incoming)
    assert out.select(F.count_distinct("user_sk")).first()[0] == out.count() == 10


def test_heads_alone_give_the_same_dimension(spark):
    """Batch after batch: heads and closed versions apart end as the merge of the whole dimension does."""
    draw = random.Random(8)
    whole = dim(spark, ("u0", "free", "US", None, at(-500), at(-100), False), ("u0", "plus", "US", None, at(-100), None, True),
                ("gone", "free", "US", None, at(-900), at(-400), False), ("gone", "plus", "US", None, at(-400), at(-50), False))
    heads, closed = split_versions(whole, "user_id")
    assert sorted((r.user_id, r.is_current) for r in heads.collect()) == [("gone", False), ("u0", True)]
    assert heads.count() + closed.count() == 4
    for n in range(3):
        rows = [
            (f"u{draw.randrange(5)}", draw.choice(["free", "plus", None]), draw.choice(["US", "DE"]), None, at(1000 * n + draw.randrange(2000)))
            for _ in range(12)
        ] + [("gone", "free", "US", None, at(-20 + n))] * (n == 1)
        incoming = batch(spark, *rows)
        whole = apply_scd_type2(whole, incoming, "user_id", TRACKED, effective_column="changed_at").drop("change_kind").checkpoint()
        heads, more = merge_heads(heads, incoming, "user_id", TRACKED, effective_column="changed_at")
        heads, more = heads.drop("change_kind").checkpoint(), more.drop("change_kind")
        closed = closed.unionByName(more, allowMissingColumns=True).checkpoint()
        columns = [*ATTRIBUTES, "user_id", "valid_from", "valid_to", "is_current"]
        both = heads.select(columns).unionByName(closed.select(columns))
        assert sorted(map(str, both.collect())) == sorted(map(str, whole.select(columns).collect()))
        assert heads.count() == heads.select("user_id").distinct().count()


def test_a_batch_reads_no_closed_version(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    day = lambda n: f"2024-01-0{n}"
    for n, tier in ((1, "free"), (2, "plus")):
        changes = batch(spark, ("u1", tier, "US", None, at(86_400 * n)), ("u2", "free", "US", None, at(5)))
        changes = changes.withColumns({"display_name": F.lit("x"), "account_status": F.lit("active")})
        store_users(warehouse, changes, day(n))
    closed = warehouse.path("WAREHOUSE", "DIM_USERS_CLOSED")
    files = set(warehouse.read("DIM_USERS_CLOSED").inputFiles())
    for file in files:  # a batch that read them would fail
        name = file.removeprefix("file://")
        os.chmod(name, 0o600)
        with open(name, "r+b") as f:
            f.truncate(3)
    changes = batch(spark, ("u1", "free", "US", None, at(86_400 * 3)))
    changes = changes.withColumns({"display_name": F.lit("x"), "account_status": F.lit("active")})
    store_users(warehouse, changes, day(3))
    assert {p for p in os.listdir(closed) if p.startswith("closed_on")} == {f"closed_on={day(2)}", f"closed_on={day(3)}"}
    assert read_users(warehouse, day(1)).count() == 2
    heads = warehouse.read_snapshot("DIM_USERS", day(3)).collect()
    assert {r.user_id: r.user_tier for r in heads} == {"u1": "free", "u2": "free"}
