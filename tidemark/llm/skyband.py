"""How far the sources of a language lie apart, and the terms that mark each of them.

A group is a (lang, source); its terms are runs of letters (A-Z lower-cased, any character
beyond ASCII counts as a letter). A language keeps the terms of at least ``least`` of its
documents. Each group, and each language, gives each kept term a share in whole billionths,
p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)), so that all results are exact.

* `pair`: the sum over all kept terms of the distance of two sources' shares. Terms are dealt
  to blocks and sources to tiles; a task holds the counts of one block for two tiles and gives
  one sum per pair of sources, and the sums of the blocks are added up.
* `term`: the terms whose share in the group is above that in the language, most above first.
  A term dominates another if its count in the group is at least as high, its count in the
  language at most as high, and it comes earlier by UTF-8: then it ranks before it, whatever
  the totals are. So what fewer than k others dominate (the k-skyband) holds the k first ones.
  Each partition keeps its own skyband of each group, these are merged to the skyband of the
  group, and what is left is ranked by its exact value.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import store

#: Bytes that are part of no term: those of ASCII but for its letters.
BREAKS = (*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))
SCALE = 1_000_000_000
PRIOR = 5
LEAST = 30
TOP = 50
#: Expected terms of a block and sources of a tile.
BLOCK = 256
TILE = 256
#: Terms a worker counts before it hands the counts on, and characters it cuts at a time.
HELD = 200_000
PIECE = 4_000_000
#: Rows of a group that are held before those dominated go.
PENDING = 4096

_PLAIN = bytes(0x20 if b in BREAKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
COUNTS = "lang string, source string, term string, n bigint, docs bigint"
SUMS = "lang string, a string, b string, value bigint"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in order, piece by piece."""
    plain, at = text.translate(_PLAIN), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, source, text) rows, added up as far as a worker may hold them.

    Each group also has a row without a term.
    """
    said: dict[tuple, Counter] = {}
    seen: dict[tuple, Counter] = {}
    held = 0

    def out() -> pa.RecordBatch:
        rows = [(*g, None, 0, 0) for g in said]
        rows += [(*g, t, n, seen[g][t]) for g, c in said.items() for t, n in c.items()]
        names = ["lang", "source", "term", "n", "docs"]
        types = [pa.binary()] * 3 + [pa.int64()] * 2
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([c.cast(pa.string()) if pa.types.is_binary(c.type) else c for c in columns], names)

    for batch in batches:
        columns = [pc.fill_null(batch.column(i), "").cast(pa.binary()) for i in range(3)]
        for lang, source, text in zip(*(c.to_pylist() for c in columns)):
            group = (lang, source)
            count, docs = said.setdefault(group, Counter()), seen.setdefault(group, Counter())
            before, own = len(count), set()
            for words in terms(text):
                count.update(words)
                own.update(words)
            docs.update(own)
            held += len(count) - before
            if held > HELD or len(said) > HELD:
                yield out()
                said, seen, held = {}, {}, 0
    if said:
        yield out()


def kept_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST) -> DataFrame:
    """(lang, source, term, in_group, in_lang, first): counts of kept terms, stored.

    ``first`` marks one row of each term of a language. Each group has a row without a term.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    counted = rows.mapInArrow(_counted, COUNTS).repartition("lang", "term")  # serves the sums and the window
    by = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("in_group"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    by = by.select(
        "lang", "source", "term", "in_group",
        F.sum("in_group").over(over).alias("in_lang"),
        F.sum("docs").over(over).alias("_docs"),
        (F.min("source").over(over) == F.col("source")).alias("first"),
    )
    return store(by.where((F.col("_docs") >= least) | F.col("term").isNull()).drop("_docs"), "terms")


def group_totals(kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, n_terms), one row per group."""
    groups = kept.groupBy("lang", "source").agg(F.sum("in_group").alias("total"))
    is_new = F.col("first") & F.col("term").isNotNull()
    langs = kept.groupBy("lang").agg(F.sum("in_group").alias("lang_total"), F.count_if(is_new).alias("n_terms"))
    return groups.join(langs, "lang")


def share(count: str, total: str, n_terms: str) -> Column:
    """The share in billionths; whole-number arithmetic of 38 digits."""
    return F.expr(
        f"1 + (cast({count} + {PRIOR} as decimal(25, 0)) * {SCALE}BD) div cast({total} + {PRIOR} * {n_terms} as decimal(25, 0))"
    )


def _shares(count: np.ndarray, total: np.ndarray, n_terms: int) -> np.ndarray:
    """The same in numpy: ``count`` has a row per source."""
    above, below = count + PRIOR, (total + PRIOR * n_terms)[:, None]
    if above.max(initial=0) >= 2**63 // SCALE:
        above, below = above.astype(object), below.astype(object)
    return (1 + above * SCALE // below).astype(np.int64)


def _pair_sums(group: pa.Table) -> pa.Table:
    """Sums over one block of terms for the pairs of sources of two tiles (or within one)."""
    lang, left, right = (group.column(c)[0].as_py() for c in ("lang", "i", "j"))
    known = group.filter(pc.is_null(group.column("term"))).sort_by("source")
    counts = group.filter(pc.is_valid(group.column("term")))
    names, tile = known.column("source").to_pylist(), known.column("tile").to_numpy()
    term = pc.dictionary_encode(counts.column("term")).combine_chunks()
    row = pc.index_in(counts.column("source"), known.column("source").combine_chunks()).to_numpy()
    matrix = np.zeros((len(names), len(term.dictionary)), np.int64)
    matrix[row, term.indices.to_numpy()] = counts.column("in_group").to_numpy()
    out = ([], [], [])
    if len(names):
        matrix = _shares(matrix, known.column("total").to_numpy(), known.column("n_terms")[0].as_py())
        for i in np.flatnonzero(tile == left):
            others = np.flatnonzero(tile == right)
            others = others[others > i] if left == right else others
            apart = np.abs(matrix[others] - matrix[i]).sum(axis=1)
            out[0].extend([names[i]] * len(others))
            out[1].extend(names[o] for o in others)
            out[2].extend(apart.tolist())
    columns = [pa.array([lang] * len(out[0]), pa.string()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string())]
    return pa.table([*columns, pa.array(out[2], pa.int64())], ["lang", "a", "b", "value"])


def pair_distances(kept: DataFrame, totals: DataFrame, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(lang, source, item, value): the distance of each source of a language to each other."""
    most = totals.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("n_terms").alias("v")).agg(F.max("s"), F.max("v")).first()
    tiles, blocks = (-(-(m or 1) // size) or 1 for m, size in zip(most, (tile, block)))
    of = lambda column, n, seed: F.pmod(F.xxhash64(F.lit(seed), F.col(column)), F.lit(n)).cast("int")
    counts = kept.where(F.col("term").isNotNull()).select(
        "lang", "source", "term", "in_group", F.lit(None).cast("bigint").alias("total"),
        F.lit(None).cast("bigint").alias("n_terms"), of("term", blocks, "block").alias("block"),
    )
    # a task knows all sources of its tiles, also those without a term of its block
    known = totals.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("in_group"),
        "total", "n_terms", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    rows = counts.unionByName(known).withColumn("tile", of("source", tiles, "tile"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    rows = rows.withColumn("i", F.least("tile", "_other")).withColumn("j", F.greatest("tile", "_other")).drop("_other")
    sums = rows.groupBy("lang", "block", "i", "j").applyInArrow(_pair_sums, SUMS)
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return sums.select("lang", both.alias("_of"), "value").select("lang", "_of.source", "_of.item", "value")


def skyband(in_group: np.ndarray, in_lang: np.ndarray, words: list[bytes], k: int) -> np.ndarray:
    """Places of those that fewer than ``k`` others dominate.

    In the order of count, count in the language, then word, all that dominate a row come before
    it, and of those that do, the first k are in the skyband themselves: so each row is held
    against the rows kept so far.
    """
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((place, in_lang, -in_group))
    kept = np.zeros(0, np.int64)
    for at in range(0, len(order), 256):
        new = order[at : at + 256]
        known = np.concatenate([kept, new])
        over = (in_lang[known][None, :] <= in_lang[new][:, None]) & (place[known][None, :] < place[new][:, None])
        own = over[:, len(kept) :]
        own &= np.tri(len(new), k=-1, dtype=bool)
        kept = np.concatenate([kept, new[over.sum(axis=1) < k]])
    return kept


def _skybands(k: int):
    """The skyband of each group of rows (lang, source, term, in_group, in_lang) that come sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reduced(rows: pa.Table) -> pa.Table:
            counts = (rows.column(c).to_numpy() for c in ("in_group", "in_lang"))
            words = rows.column("term").cast(pa.binary()).to_pylist()
            return rows.take(pa.array(skyband(*counts, words, k)))

        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            lang, source = (rows.column(c).combine_chunks() for c in ("lang", "source"))
            new = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(source[1:], source[:-1]))
            edges = np.append(0, np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1)
            for begin, end in zip(edges, edges[1:]):
                yield from reduced(rows.slice(begin, end - begin)).to_batches()
            held = rows.slice(edges[-1])
            if held.num_rows > PENDING:
                held = reduced(held).combine_chunks()
        if held is not None and held.num_rows:
            yield from reduced(held).to_batches()

    return run


def marking_terms(kept: DataFrame, totals: DataFrame, k: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the ``k`` terms of each group whose share is most above its language's."""
    columns = ["lang", "source", "term", "in_group", "in_lang"]
    rows = kept.where("term is not null and in_group > 0").select(*columns)
    schema = "lang string, source string, term string, in_group bigint, in_lang bigint"
    part = rows.sortWithinPartitions("lang", "source").mapInArrow(_skybands(k), schema)
    merged = part.repartition("lang", "source").sortWithinPartitions("lang", "source").mapInArrow(_skybands(k), schema)
    value = share("in_group", "total", "n_terms") - share("in_lang", "lang_total", "n_terms")
    found = merged.join(totals, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.where("value > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least: int = LEAST, top: int = TOP, block: int = BLOCK, tile: int = TILE,
) -> DataFrame:
    """(lang, source, part, item, value, rank), see the module's head.

    Null text, language and source are ''. A group without kept terms has pairs, but no terms;
    a language without kept terms has distances of 0. Equal values rank by item in UTF-8.
    Repeated rows count as documents of their own; other columns are not read; an empty
    table gives no rows.
    """
    kept = kept_counts(docs, text, lang, source, least)
    totals = store(group_totals(kept), "totals")
    far = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pair_distances(kept, totals, block, tile).withColumn("rank", F.row_number().over(far))
    out = pairs.withColumn("part", F.lit("pair")).unionByName(
        marking_terms(kept, totals, top).withColumn("part", F.lit("term"))
    )
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
