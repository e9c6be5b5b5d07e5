"""Retention: which rows have expired, and dropping them with an audit trail."""

from __future__ import annotations

import datetime
import logging
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import small_table
from ..sources.warehouse import Warehouse

log = logging.getLogger(__name__)

class Policy(NamedTuple):
    """How long rows are kept, and the column their age is told by.

    ``period`` is the table's first-level partition column, ``same_day`` whether its value is the
    day of the age column; otherwise rows are no older than their partition's value.
    """

    days: int
    age: str
    period: str
    same_day: bool = True


# Days each table is kept, and the column of its age.
POLICIES = {
    "CANONICAL.DAILY_ACTIVE_USERS": Policy(1095, "_computed_at", "event_date", same_day=False),
    "CANONICAL.MONTHLY_REVENUE": Policy(2555, "_computed_at", "month_start", same_day=False),
    "CANONICAL.WEEKLY_ENGAGEMENT": Policy(1095, "_computed_at", "week_start", same_day=False),
    "RAW.SAFETY_EVENTS": Policy(90, "event_timestamp", "dt"),
    "SAFETY.QUARANTINED_ACCOUNTS": Policy(365, "quarantined_at", "quarantined_on"),
    "WAREHOUSE.FACT_API_USAGE": Policy(730, "event_timestamp", "dt"),
    "WAREHOUSE.FACT_BILLING": Policy(2555, "event_timestamp", "dt"),
    "WAREHOUSE.FACT_CONVERSATIONS": Policy(730, "event_timestamp", "dt"),
}
#: Partitions this near to the cutoff are read, should a row lie in that of a neighbouring day.
NEAR_DAYS = 2


def policies(spark: SparkSession) -> DataFrame:
    rows = [(table, p.days, p.age) for table, p in POLICIES.items()]
    return small_table(
        spark, rows, "table_name string, retention_days int, timestamp_column string"
    )


def cutoff(table: str, as_of: str) -> str | None:
    """First day still kept, or None for a table without policy."""
    if table not in POLICIES:
        return None
    kept = datetime.timedelta(days=POLICIES[table].days)
    return (datetime.date.fromisoformat(as_of[:10]) - kept).isoformat()


def _expired(table: str, as_of: str) -> Column:
    """A row without timestamp never expires."""
    limit = F.lit(cutoff(table, as_of)).cast("date")
    return F.coalesce(F.col(POLICIES[table].age) < limit, F.lit(False))


def expired_count(df: DataFrame, table: str, as_of: str) -> DataFrame:
    """One row: table, its cutoff, rows expired and rows kept."""
    gone = _expired(table, as_of)
    return df.agg(
        F.count_if(gone).alias("expired_rows"), F.count_if(~gone).alias("kept_rows")
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(cutoff(table, as_of)).cast("date").alias("cutoff_date"),
        "expired_rows",
        "kept_rows",
    )


def keep_unexpired(df: DataFrame, table: str, as_of: str) -> DataFrame:
    """The rows retention leaves in place; a table without policy is left alone."""
    return df if cutoff(table, as_of) is None else df.where(~_expired(table, as_of))


def audit_rows(counts: DataFrame, as_of: str) -> DataFrame:
    """Audit log entries; tables with nothing to delete leave none."""
    return counts.where(F.col("expired_rows") > 0).select(
        "table_name",
        F.col("expired_rows").alias("records_deleted"),
        "cutoff_date",
        F.to_timestamp_ntz(F.lit(as_of)).alias("executed_at"),
    )


def _doubtful(table: str, as_of: str) -> tuple[str | None, str]:
    """Bounds of partition values: below the first all rows are expired, from the second on none is.

    Without a first bound each partition below the second has to be looked at.
    """
    limit, near = datetime.date.fromisoformat(cutoff(table, as_of)), datetime.timedelta(days=NEAR_DAYS)
    if POLICIES[table].same_day:
        return (limit - near).isoformat(), (limit + near).isoformat()
    return None, limit.isoformat()


def apply_retention(warehouse: Warehouse, table: str, as_of: str) -> int:
    """Delete a stored table's expired rows; returns how many, and logs them.

    Partitions are judged by their values: those beyond doubt are dropped or left alone without
    reading a column (rows of dropped ones are counted from the files' footers), only the
    few around the cutoff are read, and rewritten where they hold both. A flat table
    is refused, since rewriting it in place could lose it half-way. The log entry follows the
    delete, so that it never names rows that are still there.
    """
    if cutoff(table, as_of) is None:
        log.warning("no retention policy for %s", table)
        return 0
    schema, name = table.split(".")
    stored = warehouse.partitions(name, schema)
    if not stored:
        if warehouse.read(name, schema).isEmpty():
            return 0
        raise ValueError(f"{table} has no partitions to drop or rewrite")
    period = stored[0][0]
    data = warehouse.read(name, schema)
    low, high = _doubtful(table, as_of)
    values = [v for _, v in stored if v[0].isdigit()]
    # another partition column than the policy's says nothing about age
    known = period == POLICIES[table].period
    sure = [v for v in values if known and low is not None and v < low]
    doubtful = [v for _, v in stored if v not in sure and not (known and v[0].isdigit() and v >= high)]
    day = F.col(period)
    deleted = data.where(day < F.lit(low).cast("date")).count() if sure else 0
    gone = _expired(table, as_of)
    mixed, empty = [], list(sure)
    if doubtful:
        # one row per partition: bounded by the calendar
        tally = (
            _of_partitions(data, period, doubtful)
            .groupBy(day.cast("string").alias("part"))
            .agg(F.count_if(gone).alias("expired"), F.count_if(~gone).alias("kept"))
            .where(F.col("expired") > 0)
            .collect()
        )
        deleted += sum(r.expired for r in tally)
        mixed = [r.part for r in tally if r.kept]
        empty += [r.part for r in tally if not r.kept]
    if not deleted:
        return 0
    if mixed:
        rewritten = _of_partitions(data, period, mixed).where(~gone)
        warehouse.write(rewritten, name, schema, "replace", [period])
    for value in empty:
        warehouse.drop_partition(name, schema, period, value)
    done = small_table(warehouse.spark, [(table, deleted)], "table_name string, expired_rows bigint")
    done = done.withColumn("cutoff_date", F.lit(cutoff(table, as_of)).cast("date"))
    warehouse.write(audit_rows(done, as_of), "RETENTION_AUDIT_LOG", "RAW", "append")
    return deleted


def _of_partitions(data: DataFrame, period: str, values: list[str]) -> DataFrame:
    """Rows of some partitions, by conditions that prune the others."""
    kind = data.schema[period].dataType
    return data.where(F.col(period).isin(*[F.lit(v).cast(kind) for v in values]))


def apply_all_retention(warehouse: Warehouse, as_of: str) -> dict[str, int]:
    """All policies; a table that fails is logged and does not stop the others."""
    deleted = {}
    for table in POLICIES:
        schema, name = table.split(".")
        try:
            if warehouse.exists(name, schema):
                deleted[table] = apply_retention(warehouse, table, as_of)
        except Exception:
            log.exception("retention failed for %s", table)
    return deleted
