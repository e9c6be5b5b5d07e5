"""Sharding by a weighted hash tree.

A tree has regions, racks and shards. A row descends from the root: at every level
each child draws a number from a hash of the row's key and the child's name, the
draw is divided by the weight of the child's subtree, and the lowest wins. A child
wins in proportion to its weight, and a changed weight alters no other child's
draw: rows move only into a subtree that gained weight or out of one that lost it.
A shard that is added gets a region of its own, so rows move only into it.

The key alone decides (and the tree), so equal texts need not share a shard. Null
keys are one key. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import uniform

#: {region: {rack: {shard number: weight}}}
Tree = dict[str, dict[str, dict[int, float]]]
CELLS = 4096


def tree_of(shards: int, base: int = 8, per_rack: int = 2, per_region: int = 4) -> Tree:
    """Shards 0 .. n-1 of weight 1: full racks for the first ``base``, then one region each."""
    tree: Tree = {}
    for s in range(shards):
        if s < base:
            region, rack = f"region{s // per_region}", f"rack{s // per_rack}"
        else:
            region, rack = f"added{s}", f"added{s}"
        tree.setdefault(region, {}).setdefault(rack, {})[s] = 1.0
    return tree


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _lowest(draws: list[tuple[Column, object]]) -> list[Column]:
    """For each child, whether its draw is the lowest; of equal ones the first wins."""
    out = []
    for i, (mine, _) in enumerate(draws):
        test = F.lit(True)
        for j, (other, _) in enumerate(draws):
            if j != i:
                test = test & (mine < other if j < i else mine <= other)
        out.append(test)
    return out


def _draw(path: str, weight: float, key: Column) -> Column:
    return -F.log(uniform(path, key)) / F.lit(weight)


def shard_of(df: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """``df`` with the int column ``out``, the shard that ``key`` descends to."""
    k = F.col(key)

    def descend(node, path: str) -> Column:
        children = [(name, child) for name, child in sorted(node.items()) if _weight(child) > 0]
        if not children:
            raise ValueError(f"no weight below {path or 'the root'}")
        draws = [(_draw(f"{path}/{name}", _weight(child), k), child) for name, child in children]
        wins = _lowest(draws)
        choice = None
        for (name, child), won in zip(children, wins):
            leaf = descend(child, f"{path}/{name}") if isinstance(child, dict) else F.lit(int(name))
            choice = F.when(won, leaf) if choice is None else choice.when(won, leaf)
        return choice

    return df.withColumn(out, descend(tree, "").cast("int"))


def number_within(df: DataFrame, group: str, key: str, order: list[str], out: str, cells: int = CELLS) -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... within each ``group``, without a gap.

    A group is cut into ``cells`` by a hash of the key; rows are numbered within a
    cell and moved by the count of the cells before. The counts are at most
    ``cells`` per group. ``group`` must follow from ``key``, and have few values.
    """
    cell = F.pmod(F.xxhash64(F.lit("cell"), F.col(key)), F.lit(cells)).cast("int")
    rows = df.withColumn("_cell", cell)
    counts = rows.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(group, "_cell").orderBy(*order)
    numbered = rows.withColumn("_row", F.row_number().over(within).cast("bigint"))
    # at most groups x cells rows of three numbers
    return (
        numbered.join(F.broadcast(starts), [group, "_cell"])
        .withColumn(out, F.col("_start") + F.col("_row") - 1)
        .drop("_cell", "_row", "_start")
    )


def assign_shards(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text", cells: int = CELLS) -> DataFrame:
    """Shard, slot and the shard among one more of each row of ``docs``.

    One row per input row: id, size (UTF-8 bytes plus 1, a null text has none),
    text_crc32, law ('key'), shard, slot, grown_shard. Repeated rows get a slot each,
    in the same shard; which of them gets which can't be told apart. An empty table
    gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).cast("bigint").alias("_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    # shard and cell follow from the id, which nothing but the id column is read for
    keyed = rows.withColumn("_key", F.coalesce(F.col("_id"), F.lit(-(1 << 63))))
    keyed = shard_of(keyed, "_key", tree_of(shards), "shard")
    keyed = shard_of(keyed, "_key", tree_of(shards + 1), "grown_shard")
    slots = number_within(keyed, "shard", "_key", ["_key", "text_crc32", "size"], "slot", cells)
    return slots.select(
        F.col("_id").alias(id), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
