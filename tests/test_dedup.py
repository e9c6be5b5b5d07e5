from conftest import at, plan_of

from tidemark.operators.dedup import deduplicate_events, drop_already_loaded

SCHEMA = "event_id string, timestamp timestamp_ntz, model string"


def events(spark):
    rows = [("e1", at(0), "a"), ("e1", at(1), "b"), ("e2", at(5), "c"), ("e3", at(9), "d")]
    return spark.createDataFrame(rows, SCHEMA)


def test_keeps_latest(spark):
    kept = {r.event_id: r for r in deduplicate_events(events(spark)).collect()}
    assert len(kept) == 3
    assert kept["e1"].timestamp == at(1) and kept["e1"].model == "b"


def test_keeps_earliest(spark):
    kept = {r.event_id: r for r in deduplicate_events(events(spark), order="asc").collect()}
    assert kept["e1"].timestamp == at(0)


def test_preserves_columns_and_is_idempotent(spark):
    once = deduplicate_events(events(spark))
    assert once.columns == events(spark).columns
    assert sorted(deduplicate_events(once).collect()) == sorted(once.collect())


def test_equal_timestamps_give_the_same_row_however_partitioned(spark):
    rows = [("e1", at(0), m) for m in "abcdefgh"]
    df = spark.createDataFrame(rows, SCHEMA)
    picks = {deduplicate_events(df.repartition(n)).first().model for n in (1, 2, 3, 7)}
    assert len(picks) == 1


def test_null_ids_form_one_group(spark):
    df = spark.createDataFrame([(None, at(0), "a"), (None, at(1), "b")], SCHEMA)
    assert deduplicate_events(df).count() == 1


def test_copies_are_cut_before_the_shuffle(spark):
    plan = plan_of(deduplicate_events(events(spark)))
    assert "row_number(), 1, Partial" in plan


def test_loaded_ids_are_left_out(spark):
    loaded = spark.createDataFrame([("e1",)], "event_id string")
    kept = drop_already_loaded(deduplicate_events(events(spark)), loaded)
    assert {r.event_id for r in kept.collect()} == {"e2", "e3"}
