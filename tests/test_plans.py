"""Physical plans of the registered queries: pushdown, no cross joins, no Python."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from registry import inputs
from registry.queries import QUERIES
from tidemark.functions.timestamps import on_day

SF = "/root/testdata/sf0.001"
# These write files or run a stream before they return.
WRITING = {
    "scan_partition_day",
    "write_partition_roundtrip",
    "backfill_jsonl_flatten",
    "stream_ingest",
    "stream_dedup",
    "stream_sessions",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert bad not in plan


def test_day_filter_reaches_the_scan(spark):
    events = inputs.table(spark, SF, "events")
    plan = plan_of(events.where(on_day("ts", "2024-01-15")).select("event_id"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["monthly_revenue_all"](spark, SF))
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "o_custkey" not in schema and "o_orderkey" not in schema


def test_skewed_join_is_split_at_run_time(spark):
    """Beyond a broadcast, AQE splits the hot partition of a plain session join."""
    from tidemark.operators.sessions import sessionize

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        hot = F.col("id") % 3 == 0
        rows = spark.range(60_000).repartition(8).select(
            F.col("id").cast("string").alias("event_id"),
            F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
            F.when(hot, F.lit(0)).otherwise(F.col("id") * 60)
            .cast("timestamp").alias("timestamp"),
        )
        out = sessionize(rows)
        assert out.where("computed_session_id is not null").count() == 60_000
        out.write.format("noop").mode("overwrite").save()
        final = sessionize(rows)
        final.collect()
        assert "skewed" in plan_of(final)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
