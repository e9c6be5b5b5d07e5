"""A trie of conversations by their shared prefixes, built from hashes of blocks of turns.

A node is a distinct sequence of the first d turns of some conversation. To find them:

1. Turns are numbered within their conversation and reduced to a digest (128 bits of SHA-256 of
   role and text) and a length: no text is shuffled.
2. ``BLOCK`` turns in a row are a block. A block is named by what comes before it (a digest of
   the digests of all earlier blocks, by a tree of groups of ``WIDTH``, so that a conversation of
   any length is hashed by many tasks) and by its own digests. Conversations are grouped by
   block after block that way, one row per block and conversation.
3. A block that has no sibling, no other block after the same blocks, is a path: its turns are
   nodes with the members of the block. Only blocks that have siblings are refined turn by
   turn: their prefixes are grouped, one row per distinct block and turn.

Sums over subtrees need no walk over the tree. A node belongs to its least member, so that a
conversation owns the lower end of its path, from some depth on: a chain. Below a node lie the
rest of its own chain and all chains of other conversations that run through it and begin
further down. Each chain therefore adds its totals to the nodes above its top, which are
turns that it shares with others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import store

BLOCK = 4
WIDTH = 64
#: Depths of a chain that are summed by one task.
CELL = 256
#: Children that meet their parent in one row, and ids that are joined in one row, at most.
CHILDREN = 10  # bits
IDS = 12  # bits
HEAD = 6  # a conversation takes over fewer turns than this
FAMILY = 100

NO_IDS = hashlib.sha256(b"").hexdigest()


def _digest(text: Column) -> Column:
    return F.left(F.sha2(text, 256), F.lit(32))


def numbered_turns(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, position, digest, length): turns in order, from 1; a null turn number comes first, ties go by digest.

    Rows are sorted over all conversations and numbered within a partition; a conversation that
    lies in several partitions is put together from their counts. Rows without an id are in no
    conversation.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("conv"), F.col(turn).alias("turn"),
        _digest(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)).alias("digest"),
        F.length(text_).cast("bigint").alias("length"),
    )
    rows = rows.groupBy("conv", "turn", "digest", "length").agg(F.count(F.lit(1)).alias("n"))  # repeated rows
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    rows = store(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    counts = rows.groupBy("conv", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv", "part", F.sum("n").over(earlier).alias("start")).where("start is not null")
    within = Window.partitionBy("part", "conv").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    # sorted partitions share a conversation with their neighbours only: fewer rows than partitions
    rows = rows.join(F.broadcast(starts), ["conv", "part"], "left")
    first = F.coalesce(F.col("start"), F.lit(0)) + F.col("before") + 1
    return rows.select("conv", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("position"), "digest", "length")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another one: (conv, position, digest, length) and (conv, n_turns).

    Conversation c starts with the first h = crc32(c) % 6 turns of conversation c - c % 100, all
    if it has fewer, and goes on with its own turns after its first h.
    """
    taken_over = lambda c: F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(HEAD))
    family = F.col("conv") - F.col("conv") % FAMILY
    convs = turns.groupBy("conv").agg(F.max("position").alias("own"))
    convs = convs.withColumn("head", taken_over("conv")).withColumn("family", family)
    first = F.col("conv") % FAMILY == 0
    sizes = convs.where(first).select(F.col("conv").alias("family"), F.col("own").alias("_there"))
    convs = convs.join(sizes, "family", "left")  # at most 2 * FAMILY - 1 conversations share one
    convs = convs.withColumn("taken", F.least("head", F.coalesce("_there", F.lit(0))))
    convs = store(convs.select("conv", "family", "head", "taken", F.greatest(F.col("own") - F.col("head"), F.lit(0)).alias("_rest")), "convs")
    heads = turns.where(first & (F.col("position") < HEAD)).withColumnRenamed("conv", "family")
    begin = convs.where("taken > 0").join(heads, "family").where(F.col("position") <= F.col("taken"))
    short = convs.where("taken < head").select("conv", (F.col("head") - F.col("taken")).alias("_less"))
    rest = turns.where(F.col("position") > taken_over("conv")).join(short, "conv", "left")
    rest = rest.withColumn("position", F.col("position") - F.coalesce("_less", F.lit(0)))
    columns = ["conv", "position", "digest", "length"]
    return begin.select(*columns).unionByName(rest.select(*columns)), convs.select("conv", (F.col("taken") + F.col("_rest")).alias("n_turns"))


def _named(rows: DataFrame, carried: list[str], width: int) -> DataFrame:
    """``rows`` (conv, i, mark, ...) with digests of the marks before each and through each.

    They are equal for equal sequences of marks. Groups of ``width`` are digested, then groups of
    groups, until each conversation is one group.
    """
    items = F.sort_array(F.collect_list(F.struct("i", "mark", *carried)))
    groups = rows.groupBy("conv", F.floor(F.col("i") / width).alias("group")).agg(items.alias("items"))
    groups = store(groups.withColumn("marks", F.transform("items", lambda x: x["mark"])), "blocks")
    if (groups.agg(F.max("group")).first()[0] or 0) > 0:
        whole = groups.select("conv", F.col("group").alias("i"), _digest(F.array_join("marks", "")).alias("mark"))
        upper = _named(whole, [], width).select("conv", F.col("i").alias("group"), F.col("before").alias("_first"), F.col("through").alias("_last"))
        groups = groups.join(upper, ["conv", "group"])
    else:
        groups = groups.withColumn("_first", F.lit("")).withColumn("_last", F.lit(None).cast("string"))
    rows = groups.select("conv", "marks", "_first", "_last", F.posexplode("items").alias("_at", "_item"))
    upto = lambda n: _digest(F.concat("_first", F.lit("|"), F.array_join(F.slice("marks", F.lit(1), n), "")))
    before = F.when(F.col("_at") == 0, F.col("_first")).otherwise(upto(F.greatest("_at", F.lit(1))))
    through = F.when(F.col("_at") == width - 1, F.col("_last"))
    through = F.coalesce(through, upto(F.col("_at") + 1))
    return rows.select("conv", "_item.i", *[f"_item.{c}" for c in carried], before.alias("before"), through.alias("through"))


def _blocks(turns: DataFrame, block: int, width: int) -> DataFrame:
    """(conv, first, digests, lengths, before, through): blocks of turns, ``first`` turns stand before."""
    listed = F.sort_array(F.collect_list(F.struct("position", "digest", "length")))
    rows = turns.groupBy("conv", F.floor((F.col("position") - 1) / block).alias("i")).agg(listed.alias("_turns"))
    rows = rows.select(
        "conv", "i", F.transform("_turns", lambda t: t["digest"]).alias("digests"),
        F.transform("_turns", lambda t: t["length"]).alias("lengths"),
    )
    rows = rows.withColumn("mark", _digest(F.array_join("digests", "")))
    rows = _named(rows, ["digests", "lengths"], width)
    return rows.select("conv", (F.col("i") * block).alias("first"), "digests", "lengths", "before", "through")


def _keys(block: int) -> Column:
    """The names of the nodes of a block, one per turn; that of a full block's end names what comes before the next."""
    prefix = lambda n: _digest(F.concat(F.col("before"), F.lit(":"), F.array_join(F.slice("digests", F.lit(1), n), "")))
    each = F.sequence(F.lit(1), F.size("digests"))
    return F.transform(each, lambda n: F.when(n == block, F.col("through")).otherwise(prefix(n)))


def _nodes(blocks: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """(key, parent, depth, length, n_convs, conv): conv is the least member."""
    same = ["before", "through", "first", "digests", "lengths"]
    distinct = store(blocks.groupBy(*same).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")), "distinct-blocks")
    split = distinct.groupBy("before").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("before")
    split = store(split, "split-blocks")  # of known size: where it is small, blocks needn't be shuffled to meet it

    def turns(of: DataFrame) -> DataFrame:
        of = of.withColumn("_keys", _keys(block))
        parents = F.concat(F.array("before"), F.slice("_keys", F.lit(1), F.size("_keys") - 1))
        of = of.select("first", "n_convs", "conv", F.posexplode(F.arrays_zip(F.col("_keys").alias("key"), parents.alias("parent"), F.col("lengths").alias("length"))).alias("_at", "_node"))
        return of.select("_node.key", "_node.parent", (F.col("first") + F.col("_at") + 1).alias("depth"), "_node.length", "n_convs", "conv")

    paths = turns(distinct.join(split, "before", "left_anti"))
    refined = turns(distinct.join(split, "before", "left_semi")).groupBy("key", "parent", "depth", "length")
    refined = refined.agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"))
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0").select(
        F.lit("").alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(0).cast("bigint").alias("length"), "n_convs", "conv",
    )
    return paths.unionByName(refined).unionByName(root)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each key, whose chunks come in order; holds one digest, not the ids."""
    key, state = None, None
    for batch in batches:
        keys, hashes = [], []
        for this, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if this != key:
                if state is not None:
                    keys.append(key)
                    hashes.append(state.hexdigest())
                key, state = this, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(hashes, pa.string())], ["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def _ends(blocks: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end."""
    last = convs.where("n_turns > 0").select("conv", (F.floor((F.col("n_turns") - 1) / block) * block).alias("first"))
    at = blocks.join(last, ["conv", "first"]).select("conv", F.element_at(_keys(block), -1).alias("key"))
    at = at.unionByName(convs.where("n_turns = 0").select("conv", F.lit("").alias("key")))
    ids = F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",")
    chunks = at.groupBy("key", F.shiftright("conv", IDS).alias("chunk")).agg(ids.alias("ids"))
    return chunks.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(_hashed, "key string, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK, width: int = WIDTH, cell: int = CELL) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: (conv, position from 1, digest, length); ``convs``: (conv, n_turns) of all
    conversations, also those without turns, which end at the root. A node is named by its least
    member and its depth. Without conversations there is no node.
    """
    blocks = store(_blocks(turns, block, width), "paths")
    nodes = store(_nodes(blocks, convs, block), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    nodes = store(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("length")), "nodes")
    chains = nodes.groupBy("conv").agg(
        F.min("depth").alias("top"), F.min_by("parent", "depth").alias("parent"),
        F.sum("saved").alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaf"),
    )
    chains = store(chains, "chains")
    hung = chains.where("top > 0")
    # what each chain adds to the nodes above it
    above = blocks.join(hung.drop("parent"), "conv").where("first < top").withColumn("_keys", _keys(block))
    within = F.slice("_keys", F.lit(1), F.least(F.size("_keys"), (F.col("top") - 1 - F.col("first")).cast("int")))
    above = above.select(F.explode(within).alias("key"), "saved", "leaf")
    above = above.unionByName(hung.select(F.lit("").alias("key"), "saved", "leaf"))
    above = above.groupBy("key").agg(F.sum("saved").alias("_hung"), F.sum("leaf").alias("_leaves"))
    # and what is left of a node's own chain from there on, where others share it
    shared = nodes.where("n_convs > 1").withColumn("_cell", F.floor(F.col("depth") / cell))
    down = Window.partitionBy("conv", "_cell").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.partitionBy("conv").orderBy(F.desc("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    cells = shared.groupBy("conv", "_cell").agg(F.sum("saved").alias("_sum"))
    cells = cells.select("conv", "_cell", F.coalesce(F.sum("_sum").over(below), F.lit(0)).alias("_deeper"))
    cells = cells.join(chains.select("conv", "leaf"), "conv")
    own = shared.select("key", "conv", "_cell", F.sum("saved").over(down).alias("_own")).join(cells, ["conv", "_cell"])
    own = own.select("key", (F.col("_own") + F.col("_deeper")).alias("_own"), "leaf")
    # the owner of a chain's parent: children come in chunks, so that a hot parent meets few rows
    tops = hung.groupBy("parent", F.shiftright("conv", CHILDREN).alias("_chunk")).agg(F.collect_list(F.struct("conv", "top")).alias("_of"))
    owner = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    tops = tops.join(owner, "parent").select(F.explode("_of").alias("_of"), "parent_conv_id")
    tops = tops.select("_of.conv", F.col("_of.top").alias("depth"), "parent_conv_id")
    out = nodes.join(above, "key", "left").join(own, "key", "left").join(_ends(blocks, convs, block), "key", "left")
    out = out.join(tops, ["conv", "depth"], "left")
    alone = F.col("n_convs") == 1
    sum_of = lambda a, b: (F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).cast("bigint")
    return out.select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv")).alias("parent_conv_id"),
        F.col("n_convs").cast("bigint").alias("n_convs"), "n_children",
        F.when(alone, F.lit(1).cast("bigint")).otherwise(sum_of("_leaves", "leaf")).alias("n_leaves"),
        F.when(alone, F.lit(0).cast("bigint")).otherwise(sum_of("_hung", "_own")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame, **options) -> DataFrame:
    """The trie of a table of turns (conv_id, turn, role, text) whose conversations are rebuilt, see `rebuilt`.

    Null role or text is empty; a null turn number comes first, ties go by a digest of role and
    text, and repeated rows are turns of their own; rows without conv_id are in no conversation;
    other columns are not read; an empty table gives no rows.
    """
    turns = store(numbered_turns(conversations), "numbered-turns")
    return trie(*rebuilt(turns), **options)
