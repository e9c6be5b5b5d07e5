"""Dimensions: users (change feed and merge), models, plans, calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..functions.enrich import surrogate_key
from ..operators.dedup import deduplicate_events
from ..operators.joins import date_key, merge_insert_if_absent
from ..operators.scd2 import apply_scd_type2, empty_dimension, merge_heads
from ..session import small_table
from ..sources.warehouse import Warehouse

# The user attributes whose change opens a new version.
TRACKED_COLUMNS = ["user_tier", "country_code", "display_name", "organization_id", "account_status"]

# Model seed rows (prices in USD per million tokens).
MODEL_SEED = [
    ("gpt-4o", "gpt-4", "4o-2024-08-06", 128000, 16384, 2.50, 10.00, "2024-05-13"),
    ("gpt-4o-mini", "gpt-4", "4o-mini-2024-07-18", 128000, 16384, 0.15, 0.60, "2024-07-18"),
    ("gpt-4-turbo", "gpt-4", "turbo-2024-04-09", 128000, 4096, 10.00, 30.00, "2024-04-09"),
    ("gpt-3.5-turbo", "gpt-3.5", "0125", 16385, 4096, 0.50, 1.50, "2024-01-25"),
    ("o1-preview", "o1", "preview-2024-09-12", 128000, 32768, 15.00, 60.00, "2024-09-12"),
    ("o1-mini", "o1", "mini-2024-09-12", 128000, 65536, 3.00, 12.00, "2024-09-12"),
]

# Plan seed rows (prices in USD, requests per minute, tokens per day).
PLAN_SEED = [
    ("plan_free", "Free", 0.0, 0.0, 10, 10000),
    ("plan_plus", "Plus", 20.0, 200.0, 80, 1000000),
    ("plan_enterprise", "Enterprise", 60.0, 600.0, 500, 10000000),
]


def user_changes(user_events: DataFrame, timestamp_column: str = "timestamp") -> DataFrame:
    """Deduplicated signups and tier changes, in the shape of the dimension.

    A tier change names its tier ``new_tier`` and nothing else; attributes it
    does not mention are NULL here and carried forward by the merge.
    """
    changes = deduplicate_events(user_events, timestamp_column=timestamp_column).where(
        F.col("event_type").isin("user_signup", "user_tier_change")
    )
    is_signup = F.col("event_type") == "user_signup"
    return changes.select(
        "user_id",
        "email_hash",
        "display_name",
        "country_code",
        F.coalesce("user_tier", "new_tier").alias("user_tier"),
        "organization_id",
        "platform",
        F.when(is_signup, F.col(timestamp_column)).alias("signup_date"),
        F.when(is_signup, F.lit("active")).alias("account_status"),
        F.col(timestamp_column).alias("changed_at"),
    )


HEADS, CLOSED = "DIM_USERS", "DIM_USERS_CLOSED"


def store_users(warehouse: Warehouse, changes: DataFrame, day: str) -> None:
    """Merges the day's changes into the stored user dimension.

    DIM_USERS holds each user's newest version, one snapshot per day; DIM_USERS_CLOSED holds the
    versions before, by the day that closed them. A day reads the heads before it and writes
    its heads and what it closed, so closed versions are written once. A rerun replaces both.
    """
    before = warehouse.read_snapshot(HEADS, day, before=True)
    if before is None:
        before = empty_dimension(changes, "changed_at")
    heads, closed = merge_heads(before, changes, "user_id", TRACKED_COLUMNS, effective_column="changed_at")
    closed = closed.drop("change_kind").withColumn("closed_on", F.lit(day).cast("date"))
    warehouse.write(closed, CLOSED, mode="replace", partition_by=["closed_on"], period=("closed_on", day))
    warehouse.write_snapshot(heads.drop("change_kind"), HEADS, day)


def drop_users(warehouse: Warehouse, day: str) -> None:
    """Takes back what an earlier run of the day stored."""
    warehouse.drop_partition(HEADS, "WAREHOUSE", "snapshot", day)
    warehouse.drop_partition(CLOSED, "WAREHOUSE", "closed_on", day)


def read_users(warehouse: Warehouse, day: str) -> DataFrame | None:
    """All versions as of a day: its heads, and what was closed up to the day of their snapshot."""
    days = [d for _, d in warehouse.partitions(HEADS) if d <= day]
    if not days:
        return None
    heads = warehouse.read_snapshot(HEADS, day)
    kept = [d for _, d in warehouse.partitions(CLOSED) if d <= max(days)]
    if not kept:
        return heads
    until = F.col("closed_on") <= F.lit(max(days)).cast("date")
    closed = warehouse.spark.read.schema(StructType([*heads.schema.fields, StructField("closed_on", DateType())])).parquet(warehouse.path("WAREHOUSE", CLOSED))
    return heads.unionByName(closed.where(until).drop("closed_on"))


def merge_users(existing: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The user dimension after a batch of changes (initial load without ``existing``)."""
    if existing is None:
        existing = empty_dimension(changes, "changed_at")
    return apply_scd_type2(
        existing, changes, "user_id", TRACKED_COLUMNS, effective_column="changed_at"
    )


def seed_models(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """Model dimension; seeds are added where the model is not known yet."""
    seed = small_table(
        spark,
        MODEL_SEED,
        "model_id string, model_family string, model_version string, context_window int, "
        "max_output_tokens int, usd_per_1m_input double, usd_per_1m_output double, "
        "release_date date",
    ).withColumns(
        {
            "is_deprecated": F.lit(False),
            "model_sk": F.md5("model_id"),
        }
    )
    return seed if existing is None else merge_insert_if_absent(existing, seed, "model_id")


def seed_plans(spark: SparkSession, valid_from: str, existing: DataFrame | None = None) -> DataFrame:
    """Plan dimension, seeded likewise; seeds are valid from the given day."""
    seed = small_table(
        spark,
        PLAN_SEED,
        "plan_id string, plan_name string, monthly_price_usd double, annual_price_usd double, "
        "rate_limit_rpm int, max_tokens_per_day int",
    ).withColumns(
        {
            "models_available": F.lit(None).cast("array<string>"),
            "valid_from": F.lit(valid_from).cast("date"),
            "valid_to": F.lit(None).cast("date"),
        }
    )
    seed = seed.withColumn("plan_sk", surrogate_key("plan_id", "valid_from"))
    return seed if existing is None else merge_insert_if_absent(existing, seed, "plan_id")


def _is_us_holiday(d: Column) -> Column:
    """Federal holidays on their calendar day (no observed-day shift)."""
    month, day, weekday = F.month(d), F.dayofmonth(d), F.dayofweek(d)
    monday, thursday = weekday == 2, weekday == 5
    nth = F.ceil(day / 7)
    fixed = F.date_format(d, "MM-dd").isin("01-01", "06-19", "07-04", "11-11", "12-25")
    return (
        fixed
        | (monday & (nth == 3) & month.isin(1, 2))  # King, Presidents
        | (monday & (month == 5) & (day > 24))  # Memorial
        | (monday & (nth == 1) & (month == 9))  # Labor
        | (monday & (nth == 2) & (month == 10))  # Columbus
        | (thursday & (nth == 4) & (month == 11))  # Thanksgiving
    )


def calendar(span: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of the one-row ``span``.

    Weeks are ISO weeks, Monday is day 1; the fiscal year is the calendar year.
    """
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    return days.select(
        date_key("full_date").alias("date_key"),
        d,
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (iso_day > 5).alias("is_weekend"),
        _is_us_holiday(d).alias("is_us_holiday"),
        F.quarter(d).alias("fiscal_quarter"),
        F.year(d).alias("fiscal_year"),
    )


def days_covered(facts: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """The span of days a fact table covers, for ``calendar``."""
    day = F.to_date(ts)
    return facts.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
