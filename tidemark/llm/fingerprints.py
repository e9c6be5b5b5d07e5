"""SimHash fingerprints of documents, and the search for near ones.

Every term of a text casts a signed vote on each of 64 bits: for bit j, the
term's weight if bit j of its hash is set, minus the weight if not. The signs of
the sums are the fingerprint. Terms are runs of five words (a shorter text is one
term); a term weighs as many units as it has code points and votes as often as it
occurs. Texts are lower-cased and runs of white space count as one space.

Texts equal after that have equal fingerprints. A null text counts as empty; the
empty text has the fingerprint of the empty term. Everything is DataFrame
functions: terms are exploded and summed within the task that reads the text, so
only fingerprints are shuffled. Sums of two bits share one bigint, 32 bits each;
that is exact for texts of up to 400 million code points.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACES, fresh, store

BITS = 64
WORDS_PER_TERM = 5
RADIUS = 3
BLOCKS = 5


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), SPACES, " ")), " ")


def _ballots(term: Column, weight: Column) -> list[Column]:
    """Sums of weights whose hash has bit j (low half) or bit j + 32 (high half) set."""
    lanes = F.lit((1 << 32) + 1)
    out = []
    for j in range(BITS // 2):
        bits = F.shiftrightunsigned(term, j).bitwiseAND(lanes)
        out.append(F.sum(bits * weight).alias(f"_b{j}"))
    return out


def _signs() -> Column:
    """The fingerprint as a bigint, from the sums of `_ballots` and their total."""
    out = F.lit(0)
    for j in range(BITS):
        lane = F.col(f"_b{j % 32}")
        lane = lane.bitwiseAND(F.lit(0xFFFFFFFF)) if j < 32 else F.shiftrightunsigned(lane, 32)
        bit = (1 << j) - (1 << BITS if j == BITS - 1 else 0)
        out = out.bitwiseOR(F.when(lane * 2 > F.col("_total"), F.lit(bit)).otherwise(F.lit(0)))
    return out


def simhash(rows: DataFrame, keys: list[str], text: str, words_per_term: int = WORDS_PER_TERM) -> DataFrame:
    """One row per distinct ``keys`` with ``fingerprint`` (bigint).

    ``rows`` should be partitioned by some of ``keys`` already, else one row per
    key and task is shuffled.
    """
    cut = rows.select(*keys, _words(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
    last = F.greatest(F.size("_words") - words_per_term, F.lit(0))
    at = cut.select(*keys, "_words", F.explode_outer(F.sequence(F.lit(0), last)).alias("_from"))
    term = F.array_join(F.slice("_words", F.col("_from") + 1, F.lit(words_per_term)), " ")
    terms = at.select(*keys, term.alias("_term"))
    votes = terms.select(
        *keys,
        F.xxhash64("_term").alias("_hash"),
        (F.length("_term") + 1).cast("bigint").alias("_weight"),
    )
    sums = votes.groupBy(*keys).agg(
        F.sum("_weight").alias("_total"), *_ballots(F.col("_hash"), F.col("_weight"))
    )
    return sums.select(*keys, _signs().alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)).cast("double") / F.lit(float(BITS))


def as_text(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")


# --- each row beside its successor -------------------------------------------------


def _cell_of(key: Column, bounds: list[int]) -> Column:
    """How many of the rising ``bounds`` are at most ``key``, by binary search."""
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    table = F.lit(bounds)
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: F.when(
            F.coalesce(F.get(table, at + step - 1) <= key, F.lit(False)), at + step
        ).otherwise(at),
    )


def beside_next(docs: DataFrame, id: str, text: str, cells: int) -> DataFrame:
    """Rows (_key, _text, _cell, _lap, _at, _next): each text with the next one's.

    Order is by id (null first), then text; the first row follows the last one. Rows
    are dealt to about ``cells`` ranges of ids of like counts. The first row of a
    range also visits the range before it, as ``_lap`` 1, so that no range needs
    another; texts are shuffled once. The bounds, one per range, are all that the
    driver sees.
    """
    key = F.coalesce(F.col(id).cast("bigint"), F.lit(-(1 << 63)))
    rows = docs.select(key.alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    shares = [i / cells for i in range(1, cells)] or [0.5]
    found = rows.agg(F.percentile_approx("_key", shares, 10 * cells)).first()[0]
    bounds = sorted(set(found or []))
    if not bounds:
        return rows.select(
            "*", *[F.lit(0).alias(c) for c in ("_cell", "_lap", "_at")], F.col("_text").alias("_next")
        )
    rows = rows.select("_key", "_text", _cell_of(F.col("_key"), bounds).alias("_cell"))
    firsts = sorted(map(tuple, rows.groupBy("_cell").agg(F.min("_key")).collect()))
    visits = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    host = docs.sparkSession.createDataFrame(visits, "_key bigint, _cell int")
    guests = (
        rows.drop("_cell")
        .join(F.broadcast(host), "_key")  # one row per range
        .groupBy("_cell")
        .agg(F.min(F.struct("_key", "_text")).alias("_row"))
        .select("_row._key", "_row._text", "_cell", F.lit(1).alias("_lap"))
    )
    both = rows.select("_key", "_text", "_cell", F.lit(0).alias("_lap")).unionByName(guests)
    order = Window.partitionBy("_cell").orderBy("_lap", "_key", "_text")
    return both.select(
        "*", F.row_number().over(order).alias("_at"), F.lead("_text").over(order).alias("_next")
    )


def edited_fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", cells: int | None = None
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text is the text with its last floor(n/2) code points replaced by
    the first as many (or all) of the next document's. One row per input row:
    id, n_chars, edited_sha256, fingerprint and edited_fingerprint (hex),
    near_edited, near_next. Repeated rows each get a row.
    """
    spark = docs.sparkSession
    cells = cells or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = beside_next(docs, id, text, cells)
    size = F.length("_text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.left(F.col("_text"), size - half), F.left(F.col("_next"), half))
    rows = rows.select("_cell", "_at", "_lap", "_key", "_text", size.alias("_n"), edited.alias("_edited"))
    texts = [F.struct(F.lit(i).alias("which"), F.col(c).alias("body")) for i, c in enumerate(("_text", "_edited"))]
    parts = rows.select(
        "_cell", "_at", "_lap", "_key", "_n",
        F.when(F.col("_lap") == 0, F.sha2("_edited", 256)).alias("_sha"),
        F.explode_outer(F.when(F.col("_lap") == 0, F.array(*texts)).otherwise(F.array(texts[0]))).alias("_part"),
    ).select("_cell", "_at", "_lap", "_key", "_n", "_sha", F.col("_part.which").alias("_which"), F.col("_part.body").alias("_body"))
    keys = ["_cell", "_at", "_lap", "_key", "_n", "_sha", "_which"]
    prints = simhash(parts, keys, "_body")
    pick = [F.max(F.when(F.col("_which") == i, F.col("fingerprint"))).alias(c) for i, c in enumerate(("_own", "_mixed"))]
    one = prints.groupBy(*keys[:-1]).agg(*pick)
    order = Window.partitionBy("_cell").orderBy("_at")
    one = one.withColumn("_after", F.lead("_own").over(order)).where("_lap = 0")
    return one.select(
        F.when(F.col("_key") > -(1 << 63), F.col("_key")).alias(id),
        F.col("_n").cast("bigint").alias("n_chars"),
        F.col("_sha").alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_mixed")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_mixed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_after")).alias("near_next"),
    )


# --- search ------------------------------------------------------------------------


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks that keep all but ``radius`` of ``blocks`` blocks of bits.

    Two fingerprints that differ in at most ``radius`` bits differ in at most as
    many blocks, so they agree under one of the masks at least.
    """
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(kept) for kept in combinations(block, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def within_radius(
    queries: DataFrame, prints: DataFrame, fingerprint: str = "fingerprint",
    radius: int = RADIUS, blocks: int = BLOCKS,
) -> DataFrame:
    """All pairs (query_print, fingerprint, distance) within the Hamming radius.

    Both inputs have a bigint column ``fingerprint``; each distinct value counts
    once, null ones not at all. Every permuted table holds the fingerprints keyed by
    the bits of some blocks; a query meets those of equal key in each table, and the
    distance is then checked. Nothing is missed and nothing is capped. More blocks
    give longer keys and more tables: choose keys about as long as the log of the
    number of fingerprints.
    """
    if not 0 <= radius < blocks:
        raise ValueError("radius must be below the number of blocks")
    masks = F.lit(block_masks(radius, blocks))

    def tables(df: DataFrame, name: str) -> DataFrame:
        one = df.select(F.col(fingerprint).alias(name)).where(F.col(name).isNotNull()).distinct()
        return one.select(name, F.posexplode(masks).alias("_table", "_mask")).select(
            name, "_table", F.col("_mask").bitwiseAND(F.col(name)).alias("_bits")
        )

    met = tables(prints, "fingerprint").join(tables(queries, "query_print"), ["_table", "_bits"])
    distance = F.bit_count(F.col("query_print").bitwiseXOR(F.col("fingerprint")))
    near = met.select("query_print", "fingerprint", distance.alias("distance"))
    return near.where(F.col("distance") <= radius).distinct()


def count_near(prints: DataFrame, id: str = "doc_id", fingerprint: str = "fingerprint", every: int = 100) -> DataFrame:
    """``prints`` (hex fingerprints) with ``near_count`` for ids divisible by ``every``.

    It counts the other rows whose fingerprint is within the radius; null elsewhere.
    """
    bits = fresh(prints.columns, "_bits")
    rows = prints.withColumn(bits, F.conv(F.col(fingerprint), 16, -10).cast("bigint"))
    asked = rows.where(F.col(id) % every == 0)
    pairs = within_radius(asked.select(F.col(bits).alias("p")), rows.select(F.col(bits).alias("p")), "p")
    sizes = rows.groupBy(F.col(bits).alias("fingerprint")).agg(F.count(F.lit(1)).alias("_rows"))
    found = pairs.join(sizes, "fingerprint").groupBy("query_print").agg((F.sum("_rows") - 1).alias("near_count"))
    # met by id, not by a print that is null for most rows
    counted = asked.select(id, bits).distinct().join(found, F.col(bits) == F.col("query_print")).drop("query_print")
    return rows.join(counted, [id, bits], "left").drop(bits)


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """`edited_fingerprints` of documents, stored, with `count_near` of their own."""
    return count_near(store(edited_fingerprints(docs), "fingerprints"))
