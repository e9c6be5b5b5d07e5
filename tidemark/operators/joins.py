"""Point-in-time lookup, insert-if-absent merge, surrogate keys, orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.timestamps import time_bucket
from .timeline import BUCKET_SECONDS, carry_in


def join_valid_at(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    columns: list[str],
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Left as-of join: each fact gets ``columns`` of the version valid at its time.

    Only the distinct (key, time) pairs of the facts are laid on a timeline with the version
    starts, cut into buckets, and the last start is carried forward: linear in both, where a
    range join would pair each fact of a key with all of the key's versions. What holds at a
    pair is joined back, so that the facts' other columns are shuffled once.

    A fact without key or time gets NULLs, as does one whose key has no version then.
    Of versions that start at one instant the one that ends last holds, then the one
    with the greatest ``columns``.
    """
    starts = versions.where(F.col("valid_from").isNotNull() & F.col(key).isNotNull()).select(
        key,
        F.col("valid_from").alias(ts),
        F.struct(F.col("valid_to").isNull().alias("_open"), "valid_to", *columns).alias("_version"),
        F.lit(0).alias("_turn"),
    )
    placed = facts.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    pairs = placed.select(key, ts).distinct().withColumn("_turn", F.lit(1))
    line = pairs.unionByName(starts, allowMissingColumns=True)
    line = line.withColumn("_bucket", time_bucket(ts, bucket_seconds))
    so_far = (
        Window.partitionBy(key, "_bucket")
        .orderBy(ts, "_turn", "_version")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = carry_in(line, [key], "_bucket", [ts, "_turn"], ["_version"])
    found = (
        line.withColumn("_here", F.last("_version", ignorenulls=True).over(so_far))
        .where("_turn = 1")
        .join(before, [key, "_bucket"], "left")
        .withColumn("_found", F.coalesce("_here", "_in__version"))
    )
    holds = F.col("_found.valid_to").isNull() | (F.col(ts) < F.col("_found.valid_to"))
    found = found.select(key, ts, *[F.when(holds, F.col(f"_found.{c}")).alias(f"_at_{c}") for c in columns])
    joined = facts.join(found, [key, ts], "left")
    return joined.select(
        *[F.col(c) for c in facts.columns], *[F.col(f"_at_{c}").alias(c) for c in columns]
    )


def merge_insert_if_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """MERGE ... WHEN NOT MATCHED THEN INSERT; existing rows are left alone."""
    absent = source.join(target.select(key).distinct(), key, "left_anti")
    return target.unionByName(absent, allowMissingColumns=True)


def date_key(ts: str):
    return F.date_format(F.col(ts), "yyyyMMdd").cast("int")


def resolve_keys(
    facts: DataFrame,
    ts: str,
    dim_users: DataFrame | None = None,
    dim_models: DataFrame | None = None,
    dim_plans: DataFrame | None = None,
) -> DataFrame:
    """Add ``date_key`` and the surrogate key of each given dimension (NULL if unknown).

    The user key is the one of the version valid at event time.
    """
    out = facts.withColumn("date_key", date_key(ts))
    if dim_users is not None:
        out = join_valid_at(out, dim_users, "user_id", ts, ["user_sk"])
    if dim_models is not None:
        out = out.join(dim_models.select("model_id", "model_sk"), "model_id", "left")
    if dim_plans is not None:
        out = out.join(dim_plans.select("plan_id", "plan_sk"), "plan_id", "left")
    return out


def orphan_counts(facts: DataFrame, dim: DataFrame, key: str = "user_id") -> DataFrame:
    """Fact rows per key that the dimension lacks; counted before the anti join.

    A NULL key is an orphan too.
    """
    per_key = facts.groupBy(key).agg(F.count("*").alias("fact_rows"))
    return per_key.join(dim.select(key).distinct(), key, "left_anti")
