"""Lookups and as-of joins where one key holds a large share of the rows: plain joins, split by AQE."""

import datetime

from conftest import at, plan_of
from pyspark.sql import functions as F

from tidemark.functions.enrich import token_cost_from_dim
from tidemark.operators.anomalies import detect_zscore_anomalies
from tidemark.operators.joins import join_valid_at, resolve_keys

AQE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
}


def lopsided(spark, n=60_000):
    """A third of the rows belongs to one user, a tenth to none."""
    user = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, F.lit(None)).otherwise((F.col("id") % 500).cast("string"))
    return spark.range(n).repartition(6).select(
        user.alias("user_id"), (F.col("id") % 17).alias("x"), F.col("id").alias("event_id"),
        (F.lit(at(0)) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("event_timestamp"),
        F.concat(F.lit("m"), F.col("id") % 5).alias("model_id"),
    )


def test_scores_of_a_hot_user_are_split(spark):
    before = {k: spark.conf.get(k, None) for k in AQE}
    for k, v in AQE.items():
        spark.conf.set(k, v)
    try:
        out = detect_zscore_anomalies(lopsided(spark).checkpoint(), "x")
        rows = out.collect()
        assert len(rows) == 60_000 and "skewed" in plan_of(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_as_of_join_of_a_hot_user(spark):
    facts = lopsided(spark, 3000)
    starts = [(u, at(s), at(s + 500) if s % 1000 else None, f"{u}{s}") for u in ("hot", "7", "8") for s in range(0, 3000, 500)]
    versions = spark.createDataFrame(starts, "user_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, tier string")
    got = {r.event_id: r.tier for r in join_valid_at(facts, versions, "user_id", "event_timestamp", ["tier"]).collect()}
    assert len(got) == 3000
    for r in facts.collect():
        held = [v for v in starts if v[0] == r.user_id and v[1] <= r.event_timestamp]
        want = max(held, key=lambda v: v[1]) if held else None
        assert got[r.event_id] == (want[3] if want and (want[2] is None or r.event_timestamp < want[2]) else None)


def test_payload_of_facts_crosses_one_exchange(spark, tmp_path):
    facts = lopsided(spark, 3000).withColumn("payload", F.concat(F.lit("p"), "event_id"))
    facts.write.parquet(str(tmp_path / "f"))
    versions = spark.createDataFrame([("hot", at(0), "x")], "user_id string, valid_from timestamp_ntz, tier string")
    versions.withColumn("valid_to", F.lit(None).cast("timestamp_ntz")).write.parquet(str(tmp_path / "v"))
    read = lambda n: spark.read.parquet(str(tmp_path / n))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_valid_at(read("f"), read("v"), "user_id", "event_timestamp", ["tier"])
        plan = plan_of(joined).split("Initial Plan")[-1]
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        assert sum("payload#" in line for line in scans) == 1
        executed = plan_of(joined)
        upper = [line for line in executed.splitlines() if "Exchange hashpartitioning(user_id" in line and "event_timestamp" in line]
        assert upper  # the facts' columns are dealt once, by user and time
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookups_keep_all_rows(spark):
    models = spark.createDataFrame([("m0", "k0", 1.0, 2.0), ("m1", "k1", 3.0, 4.0)], "model_id string, model_sk string, usd_per_1m_input double, usd_per_1m_output double")
    facts = lopsided(spark, 3000).withColumn("input_tokens", F.lit(10)).withColumn("output_tokens", F.lit(10))
    keyed = resolve_keys(facts, "event_timestamp", dim_models=models)
    counts = {r.model_sk: r["count"] for r in keyed.groupBy("model_sk").count().collect()}
    assert counts == {"k0": 600, "k1": 600, None: 1800}
    cost = token_cost_from_dim(facts, models).agg(F.sum("estimated_cost_usd")).first()[0]
    assert round(cost * 1e6) == 600 * (10 + 20 + 30 + 40) and datetime
