"""Merged hours hold the same rows, also after a crash at any step."""

import json

import pytest
from conftest import at
from pyspark.sql import functions as F

from tidemark.sources import compaction, staging, topics
from tidemark.sources.files import Files
from tidemark.streaming import ingest

TOPIC = "api_usage_events"
H = 3600


def line(i, seconds):
    return json.dumps({"event_id": f"e{i}", "event_type": "api_call", "timestamp": at(seconds).isoformat(),
                       "user_id": f"u{i % 3}", "payload": {"latency_ms": i, "model_id": "m"}})


def land(spark, root, writer, rows):
    records = spark.createDataFrame([(line(i, s),) for i, s in rows], "value string")
    events = topics.flatten(topics.decode(records), TOPIC)
    landed = staging.with_partitions(events).withColumn("_ingested_at", F.current_timestamp())
    staging.write_days(landed, root, TOPIC, writer)


def content(spark, root):
    rows = staging.read_days(spark, root, TOPIC, "2024-01-01", "2024-01-09")
    return sorted((r.event_id, r.event_timestamp if "event_timestamp" in r else r.timestamp, r.latency_ms, str(r.dt), r.hr, r._ingested_at) for r in rows.collect())


@pytest.fixture()
def root(spark, tmp_path):
    for n in range(4):
        land(spark, str(tmp_path), f"w{n}", [(100 * n + i, (i % 7) * H + n) for i in range(30)])
    return str(tmp_path)


def folders(spark, root):
    hours = compaction.landed_hours(Files(spark, root), root, TOPIC)
    return {h.hour + 24 * (h.day - 1): len(f) for h, f in hours.items()}


def test_closed_hours_become_one_folder(spark, root):
    before = content(spark, root)
    assert folders(spark, root) == {h: 4 for h in range(10, 17)}
    done = compaction.compact(spark, root, TOPIC)
    assert [h.hour for h in done] == [10, 11, 12, 13]  # two hours behind 16:00
    assert folders(spark, root) == {**{h: 1 for h in range(10, 14)}, **{h: 4 for h in range(14, 17)}}
    assert content(spark, root) == before and len(before) == 120
    assert compaction.compact(spark, root, TOPIC) == []
    # a batch that comes late, then a later hour: both are merged by the next run
    land(spark, root, "late", [(900, 0)])
    land(spark, root, "w5", [(901, 20 * H)])
    assert [h.hour for h in compaction.compact(spark, root, TOPIC)] == [10, 14, 15, 16]
    assert {r[0] for r in content(spark, root)} == {r[0] for r in before} | {"e900", "e901"}
    assert len(content(spark, root)) == 122 and Files(spark, root).names(f"{root}/{compaction.HIDDEN}/{TOPIC}") == []


@pytest.mark.parametrize("step", [0, 1, 2, 3, 5, 9, 14, 17, 20])
def test_a_crash_at_any_step_is_made_good(spark, root, monkeypatch, step):
    """The n-th move or delete, or the write of the journal, fails; the next run finishes."""
    before, left = content(spark, root), [step]
    wrapped = {}

    def failing(name):
        plain = getattr(Files, name)

        def call(self, *args):
            if left[0] == 0:
                raise RuntimeError("lost")
            left[0] -= 1
            return plain(self, *args)

        return call

    for name in ("move", "delete"):
        wrapped[name] = failing(name)
    for name, call in wrapped.items():
        monkeypatch.setattr(Files, name, call)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, root, TOPIC)
    monkeypatch.undo()
    seen = content(spark, root)
    assert set(seen) == set(before)  # copies for a while, but nothing is missing
    compaction.compact(spark, root, TOPIC)
    assert content(spark, root) == before
    assert max(n for h, n in folders(spark, root).items() if h < 14) == 1


def test_a_crash_before_the_journal_leaves_all_as_it_was(spark, root, monkeypatch):
    before = content(spark, root)

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction, "small_table", lost)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, root, TOPIC)
    monkeypatch.undo()
    assert content(spark, root) == before and folders(spark, root)[10] == 4
    compaction.compact(spark, root, TOPIC)
    assert content(spark, root) == before and folders(spark, root)[10] == 1


def test_a_stream_goes_on_after_its_hours_were_merged(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "staged")
    source.mkdir()
    for n in range(3):
        (source / f"{n}.txt").write_text("\n".join(line(100 * n + i, (i % 5) * H) for i in range(20)))
        records = spark.readStream.text(str(source))
        ingest.land_topic(records, TOPIC, root, f"{root}/_checkpoints", None).awaitTermination()
        compaction.compact(spark, root, TOPIC)
    assert len(content(spark, root)) == 60 and len({r[0] for r in content(spark, root)}) == 60
    assert {n for h, n in folders(spark, root).items() if h < 12} == {1}
