"""Mixing sources to target weights over a time-varying curriculum.

A source has a target, the words it gives to the whole run, and a schedule that
says how its rate changes between the start and the end of training. Integrating
the schedule gives the words asked of it by time t; inverting that at a document's
place in its source gives the time at which the document is due. Sorting by that
time is the training order. A source whose target exceeds its size starts over.

Steps: sizes per document (stored: id, source and size, not texts); targets per
source; running sums of sizes per source, in an order given by a hash, cut into
cells so that a hot source is summed by many tasks; closed-form inversion; range
sort. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, fresh, keyed, store

#: Weights by the rank of a source's name, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Rate at the start and at the end as multiples of the mean, by the same rank.
RAMPS = ((0.5, 1.5), (1.0, 1.0), (1.5, 0.5))
TOTAL = 1.5
MOST = 2.0
CELLS = 4096


def _cycle(rank: Column, values: tuple[float, ...]) -> Column:
    return F.get(F.lit([float(v) for v in values]), F.pmod(rank, F.lit(len(values))).cast("int"))


def source_targets(
    sizes: DataFrame, source: str, size: str, weights=WEIGHTS, total: float = TOTAL, most: float = MOST
) -> DataFrame:
    """One row per source: source, source_size, weight, rank, target.

    Sources are ranked by code point, null last. Together they are asked for
    ``total`` times all words, by weight; a source gives at most ``most`` times its
    own, and what it can't give is shared among the rest by weight again. That
    fills up sources in the order of most * size / weight: with the k first ones
    full, the rest gets ``level`` per unit of weight, and the full ones are those
    whose bound is at most the level that holds before them.
    """
    by = sizes.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size"))
    every = Window.partitionBy(F.lit(0))  # one row per source from here on
    rank = F.row_number().over(every.orderBy(F.col("_source").isNull(), F.col("_source"))) - 1
    by = by.withColumn("rank", rank).withColumn("weight", _cycle(F.col("rank"), weights))
    full = (F.col("source_size") * F.lit(most)).cast("double")
    by = by.withColumn("_full", full).withColumn("_bound", F.col("_full") / F.col("weight"))
    before = every.orderBy("_bound", "rank").rowsBetween(Window.unboundedPreceding, -1)
    by = by.select(
        "*",
        (F.sum("source_size").over(every) * F.lit(total)).cast("double").alias("_asked"),
        F.sum("weight").over(every).alias("_weights"),
        F.coalesce(F.sum("_full").over(before), F.lit(0.0)).alias("_full_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("_weight_before"),
    )
    level = (F.col("_asked") - F.col("_full_before")) / (F.col("_weights") - F.col("_weight_before"))
    by = by.withColumn("_level", level)
    # the level of the first source that isn't filled holds for all after it
    open_level = F.min(F.when(F.col("_bound") > F.col("_level"), F.struct("_bound", "rank", "_level"))).over(every)
    by = by.withColumn("_open", open_level["_level"])
    target = F.least(F.col("_full"), F.coalesce(F.col("_open") * F.col("weight"), F.col("_full")))
    return by.select(F.col("_source").alias("source"), "source_size", "weight", "rank", target.alias("target"))


def running_sums(rows: DataFrame, group: str, size: str, key: list, order: list, out: str, cells: int = CELLS) -> DataFrame:
    """``rows`` with ``out``, the sum of ``size`` over the rows before within ``group``.

    The order is by a cell number that is a hash of ``key``, then ``order``. Null
    groups are a group.
    """
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(F.lit("mix"), *key), F.lit(cells)).cast("int"))
    cell_sums = rows.groupBy(group, "_cell").agg(F.sum(size).alias("_words"))
    until = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cell_sums.select(
        F.col(group).alias("_group"),
        F.col("_cell").alias("_from"),
        F.coalesce(F.sum("_words").over(until), F.lit(0)).alias("_start"),
    )
    within = Window.partitionBy(group, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_sum", F.coalesce(F.sum(size).over(within), F.lit(0)))
    met = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_cell") == F.col("_from"))
    return (
        summed.join(starts, met, "left")
        .withColumn(out, F.col("_start") + F.col("_sum"))
        .drop("_cell", "_from", "_start", "_sum", "_group")
    )


def due_time(words: Column, target: Column, start: Column, end: Column) -> Column:
    """The t in [0, 1] by which a source is asked for ``words``.

    Its rate runs in a line from start to end times the target, so that by t it is
    asked for target * (start * t + (end - start) * t^2 / 2).
    """
    share = F.least(F.lit(1.0), words / target)
    bend = (end - start) / 2
    root = F.sqrt(F.greatest(F.lit(0.0), start * start + 4 * bend * share))
    # this form of the root also holds for bend = 0
    return F.when(share <= 0, F.lit(0.0)).otherwise(2 * share / (start + root))


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, ramps=RAMPS, total: float = TOTAL, most: float = MOST, cells: int = CELLS, sort: bool = True,
    key: str | None = None,
) -> DataFrame:
    """What the mix takes of each document and when, range-sorted by that time.

    One row per input row: id, source, size (words, null text 0), source_size, target
    (of its source), taken (words, repeats counted), passes (times it is begun),
    position (the time, 0 to 1, at which it is first due; null if nothing is taken).
    A source takes its documents in an order given by a hash until its target, cut to
    whole words, is used up: the last one may be taken in part. Documents without an
    id are placed by a hash of their text. Documents without
    words take no part but are returned. Repeated rows are documents of their own;
    ``key`` names a column that tells them apart, which is returned too.
    """
    rows = docs.select(
        *([F.col(key).alias("_key")] if key else []),
        F.col(id).alias("_id"),
        F.col(source).alias("_name"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.when(F.col(id).isNull(), F.xxhash64(F.col(text))).alias("_print"),
    )
    rows = store(rows, "mix-sizes")
    by = source_targets(rows, "_name", "size", weights, total, most)
    order = ["_id", "size", "_print"] + (["_key"] if key else [])
    # a null leaves a hash as it is, so that rows with an id are placed by that alone
    placed = running_sums(rows, "_name", "size", [F.col("_id"), F.col("_print")], order, "_before", cells)
    # one row per source
    placed = placed.join(by, F.col("_name").eqNullSafe(F.col("source")), "left").drop("source")
    whole = F.floor(F.col("target")).cast("bigint")
    if not 0 < most <= 2:
        raise ValueError("a source is gone through twice at most")
    used = [
        F.greatest(
            F.lit(0), F.least(F.col("size"), whole - F.lit(p) * F.col("source_size") - F.col("_before"))
        )
        for p in range(2)
    ]
    begun = sum((F.when(words > 0, 1).otherwise(0) for words in used), F.lit(0))
    start, end = (_cycle(F.col("rank"), tuple(r[i] for r in ramps)) for i in (0, 1))
    due = [
        F.when(words > 0, due_time(F.lit(p) * F.col("source_size") + F.col("_before"), F.col("target"), start, end))
        for p, words in enumerate(used)
    ]
    out = placed.select(
        F.col("_id").alias(id), F.col("_name").alias("source"), "size", "source_size", "target",
        (used[0] + used[1]).alias("taken"), begun.cast("int").alias("passes"),
        due[0].alias("position"), due[1].alias("again"), *([F.col("_key").alias(key)] if key else []),
    )
    return out.orderBy(F.col("position").asc_nulls_last(), id) if sort else out


def mixed_documents(docs: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """The documents that `mix` takes, each as often as it is begun, in its order.

    Columns are those of ``docs``. A document that is begun twice comes at both times.
    Rows are told apart by a key (see `common.keyed`), so that each comes as often as its own plan says, also
    where an id is repeated or null. Documents without words are left out.
    """
    key = fresh([*docs.columns, "source", "size", "source_size", "target", "taken", "passes", "position", "again"], "_row")
    at, of = (fresh([*docs.columns, key], c) for c in ("_position", "_of"))
    docs = keyed(docs, key)
    plan = mix(docs, id, **options, sort=False, key=key).where("passes > 0")
    times = F.array(F.col("position"), F.col("again"))
    plan = plan.select(F.col(key).alias(of), F.explode(F.slice(times, F.lit(1), F.col("passes"))).alias(at))
    met = docs.join(plan, docs[key] == plan[of])
    return met.orderBy(at, id, key).drop(at, of, key)
