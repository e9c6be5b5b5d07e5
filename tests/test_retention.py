import datetime
import os

import pytest
from conftest import at
from pyspark.sql import functions as F

from tidemark.operators import retention
from tidemark.sources.warehouse import Warehouse

AS_OF = "2026-01-02 00:00:00"  # 730 days before: 2024-01-03


def facts(spark):
    """One row per six hours from 2024-01-01 10:00 for five days."""
    return spark.range(20).select(
        F.col("id").cast("string").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(0, id * 6)").alias(
            "event_timestamp"
        ),
    )


def test_cutoffs():
    assert retention.cutoff("WAREHOUSE.FACT_CONVERSATIONS", AS_OF) == "2024-01-03"
    assert retention.cutoff("WAREHOUSE.UNKNOWN", AS_OF) is None
    assert retention.POLICIES["CANONICAL.MONTHLY_REVENUE"].age == "_computed_at"
    assert retention.POLICIES["SAFETY.QUARANTINED_ACCOUNTS"].age == "quarantined_at"


def test_cutoff_is_strict_and_null_is_kept(spark):
    df = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 2, 23, 59),), (datetime.datetime(2024, 1, 3),), (None,)],
        "event_timestamp timestamp_ntz",
    )
    table = "WAREHOUSE.FACT_CONVERSATIONS"
    row = retention.expired_count(df, table, AS_OF).first()
    assert (row.expired_rows, row.kept_rows) == (1, 2)
    assert retention.keep_unexpired(df, table, AS_OF).count() == 2
    assert retention.keep_unexpired(df, "WAREHOUSE.UNKNOWN", AS_OF).count() == 3


def test_stored_partitions_are_dropped_or_rewritten(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    # Partitioned by landing day, one day late: a partition can hold both kinds.
    late = facts(spark).withColumn(
        "dt", F.to_date(F.col("event_timestamp") + F.expr("interval '9' hours"))
    )
    warehouse.write(late, "FACT_CONVERSATIONS", mode="replace", partition_by=["dt"])
    expected = sorted(
        r.event_id for r in late.where("event_timestamp >= date'2024-01-03'").collect()
    )
    deleted = retention.apply_all_retention(warehouse, AS_OF)
    assert deleted == {"WAREHOUSE.FACT_CONVERSATIONS": 20 - len(expected)}
    kept = spark.read.parquet(warehouse.path("WAREHOUSE", "FACT_CONVERSATIONS"))
    assert sorted(r.event_id for r in kept.collect()) == expected
    assert ("dt", "2024-01-01") not in warehouse.partitions("FACT_CONVERSATIONS")
    audit = warehouse.read("RETENTION_AUDIT_LOG", "RAW").collect()
    assert [(r.table_name, r.records_deleted) for r in audit] == [
        ("WAREHOUSE.FACT_CONVERSATIONS", 20 - len(expected))
    ]
    # Nothing left to do: no second audit entry.
    assert retention.apply_all_retention(warehouse, AS_OF) == {"WAREHOUSE.FACT_CONVERSATIONS": 0}
    assert warehouse.read("RETENTION_AUDIT_LOG", "RAW").count() == 1


def test_one_failure_does_not_stop_the_others(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    broken = facts(spark).withColumnRenamed("event_timestamp", "other").withColumn("dt", F.lit(1))
    warehouse.write(broken, "FACT_API_USAGE", mode="replace", partition_by=["dt"])
    good = facts(spark).withColumn("dt", F.to_date("event_timestamp"))
    warehouse.write(good, "FACT_CONVERSATIONS", mode="replace", partition_by=["dt"])
    deleted = retention.apply_all_retention(warehouse, AS_OF)
    assert set(deleted) == {"WAREHOUSE.FACT_CONVERSATIONS"}
    assert deleted["WAREHOUSE.FACT_CONVERSATIONS"] > 0


def test_audit_skips_tables_without_expired_rows(spark):
    counts = retention.expired_count(facts(spark), "WAREHOUSE.FACT_BILLING", AS_OF)
    assert retention.audit_rows(counts, AS_OF).isEmpty()


def test_snapshots_and_replace(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.read_snapshot("DIM", "2024-01-05") is None
    for day, v in (("2024-01-01", 1), ("2024-01-03", 3), ("2024-01-03", 4)):
        warehouse.write_snapshot(spark.createDataFrame([(v,)], "v int"), "DIM", day)
    assert [r.v for r in warehouse.read_snapshot("DIM", "2024-01-05").collect()] == [4]
    assert [r.v for r in warehouse.read_snapshot("DIM", "2024-01-02").collect()] == [1]
    assert [r.v for r in warehouse.read_snapshot("DIM", "2024-01-03", before=True).collect()] == [1]


def test_event_time_is_compared_as_stored(spark):
    df = spark.createDataFrame([(at(0),)], "event_timestamp timestamp_ntz")
    row = retention.expired_count(df, "RAW.SAFETY_EVENTS", "2024-03-31 00:00:00").first()
    assert (str(row.cutoff_date), row.expired_rows) == ("2024-01-01", 0)


def test_a_flat_table_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    old = spark.sql("select timestamp_ntz '2001-01-01 00:00:00' as event_timestamp")
    warehouse.write(old, "SAFETY_EVENTS", "RAW")
    with pytest.raises(ValueError, match="no partitions"):
        retention.apply_retention(warehouse, "RAW.SAFETY_EVENTS", AS_OF)
    assert warehouse.read("SAFETY_EVENTS", "RAW").count() == 1


def test_only_partitions_near_the_cutoff_are_read(spark, tmp_path):
    """Files of all other days are spoilt but for their footers; nothing looks into them."""
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.range(40).select(
        F.col("id").cast("string").alias("event_id"),
        F.expr("timestamp_ntz'2023-12-20 10:00:00' + make_dt_interval(id)").alias("event_timestamp"),
    )
    rows = rows.withColumn("dt", F.to_date("event_timestamp"))
    warehouse.write(rows, "FACT_CONVERSATIONS", mode="replace", partition_by=["dt"])
    near = {f"dt=2024-01-0{d}" for d in (1, 2, 3, 4)}
    for file in warehouse.read("FACT_CONVERSATIONS").inputFiles():
        if file.split("/")[-2] not in near:
            folder, name = os.path.split(file.removeprefix("file://"))
            os.remove(f"{folder}/.{name}.crc")
            with open(f"{folder}/{name}", "r+b") as f:
                f.seek(4)
                f.write(b"\0" * 12)  # the first page
    assert retention.apply_retention(warehouse, "WAREHOUSE.FACT_CONVERSATIONS", AS_OF) == 14
    left = [v for _, v in warehouse.partitions("FACT_CONVERSATIONS")]
    assert left[0] == "2024-01-03" and len(left) == 26
    assert retention.apply_retention(warehouse, "WAREHOUSE.FACT_CONVERSATIONS", AS_OF) == 0


def test_all_tables_are_counted(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    old, new = datetime.datetime(2015, 1, 1, 5), datetime.datetime(2026, 1, 1, 5)
    for table, policy in retention.POLICIES.items():
        schema, name = table.split(".")
        rows = spark.createDataFrame([("a", old, old.date()), ("b", new, new.date())], f"id string, `{policy.age}` timestamp_ntz, `{policy.period}` date")
        warehouse.write(rows, name, schema, "replace", [policy.period])
    # computed again lately: not expired, though its period is long ago
    again = spark.createDataFrame([("c", new, datetime.date(2015, 2, 1))], "id string, _computed_at timestamp_ntz, month_start date")
    warehouse.write(again, "MONTHLY_REVENUE", "CANONICAL", "append", ["month_start"])
    assert retention.apply_all_retention(warehouse, AS_OF) == {t: 1 for t in retention.POLICIES}
    assert {r.id for r in warehouse.read("MONTHLY_REVENUE", "CANONICAL").collect()} == {"b", "c"}
