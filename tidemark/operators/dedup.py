"""One row per event id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def _hashable(df: DataFrame) -> list[str]:
    """Columns xxhash64 accepts (it refuses maps, also nested ones)."""

    def has_map(t) -> bool:
        if isinstance(t, MapType):
            return True
        if isinstance(t, ArrayType):
            return has_map(t.elementType)
        if isinstance(t, StructType):
            return any(has_map(f.dataType) for f in t.fields)
        return False

    return [f.name for f in df.schema.fields if not has_map(f.dataType)]


def deduplicate_events(
    df: DataFrame,
    id_column: str = "event_id",
    timestamp_column: str = "timestamp",
    order: str = "desc",
) -> DataFrame:
    """Keep the latest (``desc``) or earliest copy of each id, all columns preserved.

    The rank filter becomes a WindowGroupLimit ahead of the shuffle, so each map
    task forwards one row per id however many copies there are. Copies with equal
    timestamps are told apart by a content hash, which makes the choice repeatable.
    """
    ts = F.col(timestamp_column)
    ranked = Window.partitionBy(id_column).orderBy(
        ts.desc() if order == "desc" else ts.asc(), F.xxhash64(*_hashable(df))
    )
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def drop_already_loaded(df: DataFrame, loaded: DataFrame, id_column: str = "event_id") -> DataFrame:
    """Rows whose id is not in ``loaded`` (a copy that arrived after midnight, say)."""
    return df.join(loaded.select(id_column), id_column, "left_anti")
