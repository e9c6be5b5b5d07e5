"""Slowly changing dimension, type 2, as a version chain.

Incoming rows are ordered by their effective time, attributes left NULL are
carried forward, of several rows at one instant the last one stands, rows that
repeat the previous state are dropped, and each kept row closes the one before it.
Comparisons are bucketed (see ``timeline``), so that a key with very many changes
does not land in one task. Rows at one instant are ordered by a hash of their
attributes, so that reruns agree. A change without key or effective time can't be
placed: it opens no version and is reported with the late ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.enrich import surrogate_key as make_key
from ..functions.timestamps import time_bucket
from ..session import cut_lineage
from .timeline import BUCKET_SECONDS, carry_in, next_start


def empty_dimension(incoming: DataFrame, effective_column: str) -> DataFrame:
    """The dimension before its first load, with the columns of ``incoming``."""
    ts = incoming.schema[effective_column].dataType
    return (
        incoming.drop(effective_column)
        .where(F.lit(False))
        .withColumns(
            {
                "valid_from": F.lit(None).cast(ts),
                "valid_to": F.lit(None).cast(ts),
                "is_current": F.lit(True),
            }
        )
    )


def _key_state(existing: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Per known key: the time up to which it is settled and its open version."""
    return existing.groupBy(key).agg(
        F.max(F.coalesce("valid_to", "valid_from")).alias("_floor"),
        F.max(F.when(F.col("is_current"), F.struct("valid_from", *attributes))).alias("_open"),
    )


def _judge(
    existing: DataFrame, incoming: DataFrame, key: str, effective: str
) -> DataFrame:
    """Incoming rows with their key's state and whether they come too late or have no place."""
    attributes = [c for c in existing.columns if c in incoming.columns and c != key]
    state = _key_state(existing, key, attributes)
    late = F.coalesce(F.col(effective) <= F.col("_floor"), F.lit(False))
    placeless = F.col(key).isNull() | F.col(effective).isNull()
    return incoming.join(state, key, "left").withColumn("_late", late | placeless)


def late_changes(
    existing: DataFrame, incoming: DataFrame, natural_key: str, effective_column: str
) -> DataFrame:
    """Changes at or before their key's settled time, and those without key or time.

    They would rewrite closed versions or have no place; the merge leaves them out,
    and a caller can report them with this.
    """
    judged = _judge(existing, incoming, natural_key, effective_column)
    return judged.where("_late").drop("_floor", "_open", "_late")


def _differs(columns: list[str], other: str) -> Column:
    return reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"{other}.{c}")) for c in columns]
    )


def _new_versions(
    accepted: DataFrame,
    key: str,
    attributes: list[str],
    tracked: list[str],
    effective: str,
    bucket_seconds: int,
) -> DataFrame:
    """Versions the accepted changes open."""
    order = [effective, "_tie"]
    place = [key, "_bucket"]
    rows = accepted.withColumns(
        {
            "_tie": F.xxhash64(*attributes),
            "_seen": F.lit(True),
            "_bucket": time_bucket(effective, bucket_seconds),
        }
    )
    rows = rows.join(carry_in(rows, [key], "_bucket", order, [*attributes, "_seen"]), place)
    chain = Window.partitionBy(*place).orderBy(*order)

    def entering(c: str) -> Column:
        """What held before the first row of this place: earlier buckets, then the open version."""
        return F.coalesce(F.col(f"_in_{c}"), F.col(f"_open.{c}"))

    known = F.col("_open").isNotNull() | F.col("_in__seen")
    following = F.lead(effective).over(chain)
    kept = (
        rows.withColumns(
            {
                "_entering": F.when(known, F.struct(*[entering(c).alias(c) for c in attributes])),
                **{
                    c: F.coalesce(F.last(c, ignorenulls=True).over(chain), entering(c))
                    for c in attributes
                },
                "_following": following,
            }
        )
        # Of several changes at one instant, all in one bucket, only the last one ever held.
        .where(F.col("_following").isNull() | (F.col("_following") > F.col(effective)))
        .withColumn(
            "_previous", F.coalesce(F.lag(F.struct(*attributes)).over(chain), F.col("_entering"))
        )
        .where(F.col("_previous").isNull() | _differs(tracked, "_previous"))
        .select(*place, "_tie", "_floor", effective, *attributes)
    )
    # Read three times from here on (closing times, chain, result).
    kept = cut_lineage(kept)
    kept = kept.join(next_start(kept, [key], "_bucket", effective), place)
    closes = F.coalesce(following, F.col("_next_start"))
    return kept.withColumn("valid_to", closes).select(
        key,
        *attributes,
        F.col(effective).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        F.when(F.col("_floor").isNull(), "new_key").otherwise("new_version").alias("change_kind"),
    )


def apply_scd_type2(
    existing_dim: DataFrame,
    incoming_data: DataFrame,
    natural_key: str,
    tracked_columns: list[str],
    surrogate_key: str | None = "user_sk",
    effective_column: str | None = None,
    as_of: str | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """The whole dimension after the batch, each row with its ``change_kind``.

    Changes take effect at their ``effective_column``; a batch without one takes
    effect as a whole at ``as_of``.

    ``history`` closed before the batch, ``untouched`` open and absent from the
    batch, ``unchanged`` open and confirmed, ``expired`` closed by the batch,
    ``new_version`` of a known key, ``new_key`` first seen in the batch.
    """
    if effective_column is None:
        if as_of is None:
            raise ValueError("name the effective_column or give as_of")
        effective_column = "_effective"
        incoming_data = incoming_data.withColumn(
            effective_column, F.to_timestamp_ntz(F.lit(as_of))
        )
    attributes = [c for c in incoming_data.columns if c not in (natural_key, effective_column)]
    instant = incoming_data.schema[effective_column].dataType
    existing = existing_dim.withColumns(
        {c: F.col(c).cast(instant) for c in ("valid_from", "valid_to")}
    )
    for c in attributes:
        if c not in existing.columns:
            existing = existing.withColumn(c, F.lit(None).cast(incoming_data.schema[c].dataType))
    existing = existing.select(natural_key, *attributes, "valid_from", "valid_to", "is_current")

    # Read several times below: to number, to fill and to tell which keys it holds.
    judged = cut_lineage(_judge(existing, incoming_data, natural_key, effective_column))
    fresh = _new_versions(
        judged.where(~F.col("_late")),
        natural_key,
        attributes,
        tracked_columns,
        effective_column,
        bucket_seconds,
    )

    never = F.lit(None).cast(instant)
    batch = (
        judged.select(natural_key, never.alias("_start"))
        .unionByName(fresh.select(natural_key, F.col("valid_from").alias("_start")))
        .groupBy(natural_key)
        .agg(F.min("_start").alias("_closes"), F.lit(True).alias("_in_batch"))
    )
    is_open = F.col("is_current")
    settled = (
        existing.join(batch, natural_key, "left")
        .withColumns(
            {
                "change_kind": F.when(~is_open, "history")
                .when(F.col("_closes").isNotNull(), "expired")
                .when(F.col("_in_batch"), "unchanged")
                .otherwise("untouched"),
                "valid_to": F.when(is_open, F.col("_closes")).otherwise(F.col("valid_to")),
                "is_current": is_open & F.col("_closes").isNull(),
            }
        )
        .drop("_in_batch", "_closes")
    )
    merged = settled.unionByName(fresh, allowMissingColumns=True)
    if surrogate_key:
        merged = merged.withColumn(surrogate_key, make_key(natural_key, "valid_from"))
    return merged


def merge_heads(
    heads: DataFrame, incoming_data: DataFrame, natural_key: str, tracked_columns: list[str], **options
) -> tuple[DataFrame, DataFrame]:
    """The merge on heads alone, the newest version of each key: (heads after it, versions it closed).

    A key's head tells all that a merge asks of its history: up to when it is settled and what
    holds now. So closed versions are neither read nor written again; a caller keeps them apart
    and adds those this returns. A head is a closed version where a key has no open one.
    """
    merged = cut_lineage(apply_scd_type2(heads, incoming_data, natural_key, tracked_columns, **options))
    kind = F.col("change_kind")
    opened = merged.where(kind.isin("new_key", "new_version")).select(natural_key).distinct()
    ended = merged.where(kind == "history")  # heads without an open version
    superseded = ended.join(opened, natural_key, "left_semi")
    kept = ended.join(opened, natural_key, "left_anti")
    after = merged.where((kind != "history") & F.col("is_current")).unionByName(kept)
    closed = merged.where((kind != "history") & ~F.col("is_current")).unionByName(superseded)
    return after, closed


def split_versions(dim: DataFrame, natural_key: str) -> tuple[DataFrame, DataFrame]:
    """A dimension's (heads, closed versions before them), to store it in two parts."""
    newest = dim.groupBy(natural_key).agg(F.max("valid_from").alias("valid_from"))
    # of versions that start at one instant (one of them empty) the open one is the head
    open_keys = dim.where("is_current").select(natural_key).distinct()
    ended = dim.join(newest, [natural_key, "valid_from"], "left_semi").join(open_keys, natural_key, "left_anti")
    heads = dim.where("is_current").unionByName(ended)
    rest = dim.where(~F.col("is_current"))
    return heads, rest.join(ended.select(natural_key, "valid_from"), [natural_key, "valid_from"], "left_anti")


def keys_with_many_current(dim: DataFrame, natural_key: str) -> DataFrame:
    """Keys that break the rule of one current version."""
    return (
        dim.where("is_current")
        .groupBy(natural_key)
        .agg(F.count("*").alias("current_rows"))
        .where(F.col("current_rows") > 1)
    )
