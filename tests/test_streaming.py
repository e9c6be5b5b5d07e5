import json

from conftest import at
from pyspark.sql import functions as F

from tidemark.operators.dedup import deduplicate_events
from tidemark.operators.sessions import session_summary
from tidemark.sources import staging, topics
from tidemark.sources.schemas import TOPICS, topic_schema
from tidemark.streaming import ingest

TOPIC = "conversation_events"


def envelope(i, seconds=0, payload=None, **more):
    body = {
        "event_id": f"e{i}",
        "event_type": "message_sent",
        "timestamp": at(seconds).isoformat() + "+00:00",
        "user_id": "u",
        "payload": {"session_id": "s", "input_tokens": 5, **(payload or {})},
    }
    return json.dumps({**body, **more})


def write_lines(path, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.txt").write_text("\n".join(lines) + "\n")


def records(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def flat(spark, lines):
    return topics.flatten(topics.decode(records(spark, lines)), TOPIC)


def test_flatten_types_and_missing_fields(spark):
    first = envelope(1, payload={"rating": "4"})
    second = json.dumps({"event_id": "e2", "event_type": "session_start"})
    rows = {r.event_id: r for r in flat(spark, [first, second]).collect()}
    assert rows["e1"].timestamp == at(0) and rows["e1"].input_tokens == 5 and rows["e1"].rating == 4
    assert rows["e2"].input_tokens is None and rows["e2"].timestamp is None
    assert flat(spark, [first]).schema.names == topic_schema(TOPIC).names


def test_payload_wins_and_nested_values_stay_json(spark):
    line = envelope(1, payload={"user_id": "inner", "topic_hint": {"a": [1, 2]}})
    row = flat(spark, [line]).first()
    assert row.user_id == "inner" and json.loads(row.topic_hint) == {"a": [1, 2]}


def test_offsets_are_converted(spark):
    line = envelope(1, timestamp="2024-01-01T12:00:00+02:00")
    assert flat(spark, [line]).first().timestamp == at(0)


def test_misfit_becomes_null(spark):
    assert flat(spark, [envelope(1, payload={"input_tokens": "many"})]).first().input_tokens is None


def test_bad_records_go_aside(spark):
    lines = [envelope(1), "{not json", json.dumps({"event_type": "x"})]
    decoded = topics.decode(records(spark, lines))
    assert topics.flatten(decoded, TOPIC).count() == 1
    assert topics.dead_letters(decoded).count() == 2


def test_round_trip_of_each_topic(spark):
    for topic in TOPICS:
        empty = spark.createDataFrame([], topic_schema(topic))
        back = topics.flatten(topics.decode(topics.to_records(empty, "timestamp")), topic)
        assert back.schema.names == topic_schema(topic).names


def test_json_lines_backfill(spark, tmp_path):
    write_lines(tmp_path / "dt=2024-01-01", [envelope(1), envelope(2, 90)])
    events = topics.flatten(
        topics.decode(topics.read_json_lines(spark, str(tmp_path / "dt=2024-01-01"))), TOPIC
    )
    assert {r.timestamp for r in events.collect()} == {at(0), at(90)}


def test_land_topic_resumes_and_sets_bad_records_aside(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"

    def run():
        stream = spark.readStream.text(str(source))
        ingest.land_topic(stream, TOPIC, str(root), str(tmp_path / "cp"), None).awaitTermination()

    write_lines(source, [envelope(1), envelope(2, 86_400), "broken"])
    run()
    write_lines(source, [envelope(3, 3600)])
    run()
    run()
    days = staging.read_days(spark, str(root), TOPIC, "2024-01-01")
    assert sorted((r.event_id, r.hr) for r in days.collect()) == [("e1", 10), ("e3", 11)]
    both = staging.read_days(spark, str(root), TOPIC, "2024-01-01", "2024-01-02")
    assert both.count() == 3 and both.where("_ingested_at is null").isEmpty()
    assert spark.read.text(str(root / "_dead_letters" / TOPIC)).count() == 1


def test_stream_and_backfill_share_a_topic(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")

    def backfill(*lines):
        events = staging.with_partitions(flat(spark, lines))
        staging.write_days(events.withColumn("_ingested_at", F.current_timestamp()), root, TOPIC)

    def land(checkpoint):
        stream = spark.readStream.text(str(source))
        ingest.land_topic(stream, TOPIC, root, str(tmp_path / checkpoint), None).awaitTermination()

    def ids():
        return sorted(r.event_id for r in staging.read_days(spark, root, TOPIC, "2024-01-01").collect())

    write_lines(source, [envelope(1)])
    land("cp")
    backfill(envelope(2), envelope(3, 3600))
    assert ids() == ["e1", "e2", "e3"]
    backfill(envelope(4))  # replaces the backfill of this hour, not the stream's rows
    assert ids() == ["e1", "e3", "e4"]
    land("another")  # batch numbers start anew, rows of the first query stay
    assert ids() == ["e1", "e1", "e3", "e4"]


def test_a_batch_tried_again_lands_once(spark, tmp_path):
    source, root, checkpoint = tmp_path / "in", str(tmp_path / "out"), tmp_path / "cp"

    def land():
        stream = spark.readStream.text(str(source))
        ingest.land_topic(stream, TOPIC, root, str(checkpoint), None).awaitTermination()

    write_lines(source, [envelope(1), envelope(2), "broken"])
    land()
    for entry in (checkpoint / TOPIC / "commits").iterdir():  # as if ended before the commit
        entry.unlink()
    land()
    assert staging.read_days(spark, root, TOPIC, "2024-01-01").count() == 2
    assert spark.read.text(f"{root}/_dead_letters/{TOPIC}").count() == 1


def test_day_scan_prunes_partitions(spark, tmp_path):
    events = staging.with_partitions(flat(spark, [envelope(1), envelope(2, 86_400)]))
    staging.write_days(
        events.withColumn("_ingested_at", F.current_timestamp()), str(tmp_path), TOPIC
    )
    day = staging.read_days(spark, str(tmp_path), TOPIC, "2024-01-02").select("event_id")
    assert [r.event_id for r in day.collect()] == ["e2"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<event_id:string>" in plan


def stream_of(spark, tmp_path, lines):
    write_lines(tmp_path / "in", lines)
    stream = spark.readStream.text(str(tmp_path / "in"))
    return topics.flatten(topics.decode(stream), TOPIC)


def test_redeliveries_match_batch_dedup(spark, tmp_path):
    lines = [envelope(i, i * 10) for i in range(20)] + [envelope(i, i * 10 + 1) for i in range(0, 20, 3)]
    unique = ingest.drop_redeliveries(stream_of(spark, tmp_path, lines), "timestamp")
    ingest.run_to_end(unique, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = deduplicate_events(flat(spark, lines))
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in batch.collect())


def test_closed_stream_sessions_match_batch(spark, tmp_path):
    seconds = [0, 100, 1900, 3700, 9000, 9100, 20_000, 40_000]
    lines = [envelope(i, s) for i, s in enumerate(seconds)]
    sessions = ingest.stream_sessions(stream_of(spark, tmp_path, lines), "timestamp")
    ingest.run_to_end(sessions, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    closed = session_summary(flat(spark, lines)).where(F.col("session_start") < at(40_000))
    assert sorted((r.session_start, r.event_count) for r in got.collect()) == sorted(
        (r.session_start, r.event_count) for r in closed.collect()
    )


def test_a_hot_id_is_cut_ahead_of_the_state(spark, tmp_path):
    """A third of the rows are copies of one id; each task passes one of them on."""
    lines = [envelope(i, i) for i in range(400)] + [envelope(7, 7 + i % 50) for i in range(200)] + [envelope(None, 3)]
    events = flat(spark, lines).repartition(4)
    cut = ingest.first_in_task(events)
    passed = {r.event_id: r["count"] for r in cut.groupBy("event_id").count().collect()}
    assert len(passed) == 401 and max(passed.values()) <= 4 and cut.columns == events.columns
    unique = ingest.drop_redeliveries(stream_of(spark, tmp_path, lines), "timestamp")
    ingest.run_to_end(unique, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = [r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == len(set(got)) == 401
