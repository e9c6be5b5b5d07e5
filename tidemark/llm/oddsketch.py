"""Near duplicates by banded MinHash, with odd sketches to judge candidates.

A document is the set of its distinct word shingles. MinHash draws ``HASHES``
samples of it; runs of some of them are its bands, and documents that agree in a band
are candidates. An odd sketch folds the samples of a document into a bitmap, where
each sample flips one bit; from the number of bits in which two bitmaps differ
follows the share of samples that differ, and so the similarity, most precisely
where it is high. Candidates whose estimate is far below the threshold go; all
others are confirmed on full sets (64-bit hashes of all shingles).

The steps, and what keeps them linear where thousands of documents are alike:

1. Texts that are equal word by word stand for one document, the least id.
2. Every member of a band's bucket meets the bucket's least member only; such
   pairs are judged and confirmed, and components formed.
3. A bucket that still holds several components is examined whole: its members are
   dealt to blocks, each pair of blocks is compared by sketches within a task, and
   the members come out that have a candidate in another component; a pair that
   shares several buckets is looked at in the first one. Those members, now with
   their full sets, are dealt to blocks again, and candidates are confirmed within
   the task, the closest first. A link comes out if it ties two components that the
   task has not tied yet, so that what comes out grows with the members and not with
   their pairs.
4. Components over the links of both steps.

A pair of candidates is either joined after step 2 or compared in step 3, so no
link between candidates is lost, whatever the size of the bucket. With 32 bands of
5 samples, a pair at similarity 0.85 fails to be a candidate with probability
1e-8, one at 0.8 with 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import spans
from .common import store
from .components import components

SHINGLE = 5
THRESHOLD = Fraction(8, 10)
BANDS = 32
ROWS = 5
#: Samples: the bands are made of the first ones, the sketch of all.
HASHES = 640
SKETCH_BITS = 2048
#: A candidate goes if its estimate is this far below the threshold: five times the
#: standard deviation of an estimate there (0.015).
MARGIN = 0.08
BLOCK = 1024
#: Shingles of a block of full sets, where it has several members.
SET_BLOCK = 1 << 21

_DRAW = np.random.Generator(np.random.PCG64(77))
_FACTOR = _DRAW.integers(1 << 31, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _DRAW.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)

SIGNATURE = "id bigint, digest bigint, digest2 bigint, n_shingles bigint, bands array<bigint>, sketch binary"


def minhashes(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Samples (sets x HASHES) of sets that begin at ``begin`` in ``hashes``; none is empty."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((HASHES, len(begin)), np.uint32)
    for i in range(HASHES):
        out[i] = np.minimum.reduceat(x * _FACTOR[i] + _SHIFT[i], begin)
    return out.T


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: a hash of its samples and its number."""
    grouped = samples[:, : BANDS * ROWS].reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for r in range(ROWS):
        key = spans.scramble(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, r])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """A bitmap (sets x SKETCH_BITS / 8 bytes) whose bits are flipped by the (place, sample) pairs."""
    number = np.arange(HASHES, dtype=np.uint64) << np.uint64(32)
    bit = spans.scramble(samples.astype(np.uint64) + number) % np.uint64(SKETCH_BITS)
    row = np.repeat(np.arange(len(samples)), HASHES)
    flips = np.bincount(row * SKETCH_BITS + bit.ravel().astype(np.int64), minlength=len(samples) * SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(len(samples), SKETCH_BITS), axis=1)


def similarity(differing: np.ndarray) -> np.ndarray:
    """Estimated share of equal samples, from the number of differing bits."""
    odd = np.clip(1 - 2 * np.asarray(differing, float) / SKETCH_BITS, 1e-9, 1)
    flips = np.log(odd) / np.log1p(-2 / SKETCH_BITS)  # distinct pairs in one set only
    return 1 - flips / (2 * HASHES)


def most_differing(threshold: Fraction) -> int:
    """Bits in which two sketches may differ for their pair to stay."""
    bits = np.arange(SKETCH_BITS // 2 + 1)
    return int(bits[similarity(bits) >= float(threshold) - MARGIN].max())


def _sets(column: pa.Array, size: int) -> Iterator[tuple]:
    """(first text, texts, digests of the words, shingle owners, shingle hashes) piece by piece."""
    for first, data, offsets in spans.pieces(column):
        data = spans.LOWER[data]
        start, end, text = spans.words(data, offsets)
        word = spans.Hasher(data).of(start, end)
        n = len(offsets) - 1
        yield first, n, word, text, *spans.shingles(word, text, n, size)


def _digest(word: np.ndarray, text: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each text's sequence of words."""
    count = np.bincount(text, minlength=n)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    mixed = spans.scramble(word + spans.scramble(place.astype(np.uint64) * np.uint64(2) + np.uint64(seed)))
    sums = np.append(np.uint64(0), np.cumsum(mixed))
    edge = np.append(0, np.cumsum(count))
    return spans.scramble(sums[edge[1:]] - sums[edge[:-1]] + count.astype(np.uint64)).view(np.int64)


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, word, text, owner, hashes in _sets(batch.column(1), size):
                count = np.bincount(owner, minlength=n)
                full = np.flatnonzero(count)
                bands = np.zeros((n, BANDS), np.int64)
                sketch = np.zeros((n, SKETCH_BITS // 8), np.uint8)
                if len(full):
                    samples = minhashes(hashes, (np.cumsum(count) - count)[full])
                    bands[full], sketch[full] = band_keys(samples), odd_sketches(samples)
                empty = pa.array(count == 0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(_digest(word, text, n, 11)),
                        pa.array(_digest(word, text, n, 12)),
                        pa.array(count.astype(np.int64)),
                        lists,
                        pa.array([row.tobytes() for row in sketch], pa.binary(), mask=empty.to_numpy(False)),
                    ],
                    names=["id", "digest", "digest2", "n_shingles", "bands", "sketch"],
                )

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, _, _, owner, hashes in _sets(batch.column(1), size):
                edge = np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edge), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), lists], names=["id", "shingles"])

    return run


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[:, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int32)


def _candidates(group: pa.RecordBatch, most: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and differing bits of the pairs from two blocks of a bucket (or one) that may link two components."""

    def matrix(column: str, width: int) -> np.ndarray:
        got = group.column(column)
        flat = got.flatten().to_numpy() if pa.types.is_list(got.type) else np.frombuffer(b"".join(got.to_pylist()), np.uint64)
        return flat.reshape(-1, width)

    side = group.column("side").to_numpy()
    one = group.column("i")[0] == group.column("j")[0]
    left = np.flatnonzero(side == 0)
    right = left if one else np.flatnonzero(side == 1)
    ids, component, size = (group.column(c).to_numpy() for c in ("id", "component", "n_shingles"))
    sketch, bands = matrix("sketch", SKETCH_BITS // 64), matrix("bands", BANDS)
    key = group.column("key")[0].as_py()
    out = [(np.zeros(0, np.int64),) * 3]
    for at in range(0, len(left), 64):
        mine = left[at : at + 64]
        able = component[mine][:, None] != component[right][None, :]
        less, more = np.minimum(size[mine][:, None], size[right]), np.maximum(size[mine][:, None], size[right])
        able &= less >= threshold * more  # else the sets can't be so similar
        if not able.any():
            continue
        apart = _differing(sketch[mine], sketch[right])
        x, y = np.nonzero(able & (apart <= most))
        apart = apart[x, y]
        x, y = mine[x], right[y]
        first = (bands[x] == bands[y]).argmax(axis=1)
        keep = (bands[x, first] == key) & ((ids[x] < ids[y]) | (not one))
        out.append((x[keep], y[keep], apart[keep]))
    return tuple(np.concatenate(part) for part in zip(*out))


def _members(most: int, threshold: float):
    """(key, id, component) of the members of a group that have a candidate in another component."""

    def found(group: pa.RecordBatch) -> pa.RecordBatch:
        x, y, _ = _candidates(group, most, threshold)
        return group.select(["key", "id", "component"]).take(pa.array(np.union1d(x, y)))

    return found


def _shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others."""
    flat = np.concatenate(others)
    place = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    return np.add.reduceat(one[place] == flat, np.cumsum([0] + [len(o) for o in others[:-1]]), dtype=np.int64)


def _ties(most: int, least: float, threshold: Fraction):
    """(a, b) of confirmed links that tie the components of a group together, each tie once."""

    def found(group: pa.RecordBatch) -> pa.RecordBatch:
        x, y, apart = _candidates(group, most, least)
        ids, component = group.column("id").to_numpy(), group.column("component").to_numpy()
        shingles = group.column("shingles")
        flat, edge = shingles.flatten().to_numpy(), np.append(0, np.cumsum(shingles.value_lengths().to_numpy()))
        sets = lambda i: flat[edge[i] : edge[i + 1]]
        # members in the order of their closest candidate, each with its candidates
        order = np.lexsort((apart, x))
        x, y, apart = x[order], y[order], apart[order]
        begin = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
        end = np.append(begin[1:], len(x))
        now = component.copy()
        links = []
        for k in np.argsort(apart[begin], kind="stable"):
            mine, others = x[begin[k]], y[begin[k] : end[k]]
            others = others[now[others] != now[mine]]
            own = np.sort(sets(mine))
            for at in range(0, len(others), 256):
                part = others[at : at + 256]
                shared = _shared(own, [sets(o) for o in part])
                union = len(own) + edge[part + 1] - edge[part] - shared
                for other in part[shared * threshold.denominator >= union * threshold.numerator]:
                    if now[other] != now[mine]:
                        links.append((ids[mine], ids[other]))
                        now[now == now[other]] = now[mine]
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["a", "b"])

    return found


def _by_blocks(found):
    """Apply ``found`` to each pair of blocks of a bucket that has two members or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket and pair of blocks; the last group waits for the next batch."""

        def groups(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
            batch = table.combine_chunks().to_batches()[0]
            for a, b in zip(edges, edges[1:]):
                if b - a > 1:
                    out = found(batch.slice(a, b - a))
                    if out.num_rows:
                        yield out

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")], axis=1)
            new = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            last = int(new[-1]) if len(new) else 0
            if last:
                yield from groups(table.slice(0, last), np.append(0, new))
            held = table.slice(last)
        if held is not None and held.num_rows:
            yield from groups(held, np.array([0, held.num_rows]))

    return run


def _dealt(members: DataFrame, parts: int) -> DataFrame:
    """Members (key, id, ..., blocks) once for each pair of blocks that theirs is of, sorted by pair."""
    dealt = members.withColumn("mine", F.pmod(F.xxhash64(F.lit("block"), F.col("id")), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        *[c for c in members.columns if c != "blocks"],
        F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    return dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")


def _of_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of some ids, which are stored first: where they are known to be few, no text is shuffled."""
    return texts.join(store(ids, "named"), "id", "left_semi")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """Those (a, b) whose full sets are similar enough. ``texts``: (id, text)."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = store(_of_ids(texts, named).mapInArrow(_full_sets(size), "id bigint, shingles array<bigint>"), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_y"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - shared
    close = shared * threshold.denominator >= union * threshold.numerator
    return both.where(close).select("a", "b")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text",
    size: int = SHINGLE, threshold: Fraction = THRESHOLD, block: int = BLOCK,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Words are separated by ASCII white space and A-Z lower-cased. Rows whose sets
    have |intersection| >= threshold * |union| are linked; component_id is the least
    id within reach over links, kept marks the row that has it. Texts without words
    (null, empty) have the empty set, are linked with nothing and kept. Rows that
    repeat an id are one document if their texts are equal; ids should be distinct
    otherwise. Rows with a null id are linked with nothing and come back with a null
    component, kept.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    signed = store(rows.mapInArrow(_signatures(size), SIGNATURE), "signatures")
    full = signed.where("n_shingles > 0 and id is not null")
    # 1. one for all that have the same words
    least = full.groupBy("digest", "digest2").agg(F.min("id").alias("rep"))
    same = full.select("id", "digest", "digest2").join(least, ["digest", "digest2"]).select("id", "rep")
    same = store(same.distinct(), "same-words")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reps = full.join(same.where("id = rep").select("id"), "id", "left_semi").select("id", "n_shingles", "bands", "sketch")
    reps = store(reps.dropDuplicates(["id"]), "representatives")
    # 2. each with the least of its buckets
    member = reps.select("id", F.explode("bands").alias("key"))
    bucket = member.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lead")).where("n > 1")
    buckets = store(member.join(bucket, "key").select("key", "id", "lead", "n"), "buckets")
    stars = buckets.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    most = most_differing(threshold)
    for side in ("a", "b"):
        own = reps.select(F.col("id").alias(side), F.col("sketch").alias(f"_{side}"), F.col("n_shingles").alias(f"_n{side}"))
        stars = stars.join(own, side)
    able = F.least("_na", "_nb") >= F.greatest("_na", "_nb") * F.lit(float(threshold) - 1e-9)
    stars = store(stars.where(able & (_differ("_a", "_b") <= most)).select("a", "b"), "stars")
    links = store(_confirmed(stars, rows, size, threshold), "star-links")
    # 3. buckets that are still of several components
    part = components(links, "a", "b")
    held = buckets.join(part.withColumnRenamed("node", "id"), "id", "left")
    held = held.select("key", "id", "n", F.coalesce("component", "id").alias("component"))
    span = held.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    held = held.join(span.where("_low <> _high").select("key"), "key", "left_semi").join(reps, "id")
    held = held.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).drop("n")
    least = float(threshold) - 1e-9
    undecided = _dealt(held, parts).mapInArrow(
        _by_blocks(_members(most, least)), "key bigint, id bigint, component bigint"
    )
    undecided = store(undecided.distinct(), "undecided")
    sets = _of_ids(rows, undecided.select("id").distinct()).mapInArrow(_full_sets(size), "id bigint, shingles array<bigint>")
    members = undecided.join(reps, "id")
    weight = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("total") / SET_BLOCK)).cast("int")
    members = members.join(weight, "key").withColumn("blocks", blocks).drop("n", "total").join(sets, "id")
    ties = _dealt(members, parts).mapInArrow(_by_blocks(_ties(most, least, threshold)), "a bigint, b bigint")
    links = links.unionByName(store(ties, "more-links"))
    # 4. all links
    final = components(links, "a", "b")
    group = same.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left")
    group = group.select("id", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("id", "n_shingles").join(group, "id", "left")
    component = F.coalesce(F.col("component_id"), F.col("id"))
    return out.select(
        F.col("id").alias(id), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _differ(a: str, b: str):
    """Number of differing bits of two sketches: whole bigints are compared."""
    total = F.lit(0)
    for i in range(SKETCH_BITS // 64):
        x, y = (F.conv(F.hex(F.substring(F.col(c), 8 * i + 1, 8)), 16, -10).cast("bigint") for c in (a, b))
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total
