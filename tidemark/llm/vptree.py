"""Approximate nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to shards by a hash of their id, about ``PER_SHARD`` to each. In a
task, a shard's vectors become a tree: a vantage point parts the others at the
median distance to it, and so on until a leaf is small. A search keeps its k best
and enters a half only if it may hold something better: by the triangle inequality
a half lies at least |distance to the vantage point - radius| away, and the tree
divides that by ``factor``. With factor 1 the bound is the true one and the search
exact; a smaller factor raises the bound, prunes more and may miss some.

Queries are sent to every shard in batches; the best of all shards are merged by
query. Memory is one shard and one batch of queries. Distances are in double
precision on the given vectors; equal ones go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import store

K = 10
PER_SHARD = 4096
LEAF = 64
#: Found by recall on the given tables, see the README.
FACTOR = 0.6


class Tree:
    """A vantage-point tree over the rows of ``points``; ``ids`` break ties."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids, self.leaf = points, ids, leaf
        self.nodes: list[tuple] = []  # (rows,) or (vantage row, radius, inner, outer)
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append((rows,))
        if len(rows) > self.leaf:
            far = distances(self.points[rows], self.points[rows[0]][None])[:, 0]
            radius = float(np.median(far[1:]))
            inner, outer = rows[1:][far[1:] <= radius], rows[1:][far[1:] > radius]
            # many equal distances: halves that don't shrink stay a leaf
            if len(inner) and len(outer):
                self.nodes[at] = (int(rows[0]), radius, self._grow(inner), self._grow(outer))
        return at

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids (queries x k) of the nearest points but those with the query's own id.

        Where there are fewer, the distance is infinite.
        """
        best = np.full((len(queries), k), np.inf)
        names = np.full((len(queries), k), np.iinfo(np.int64).max)

        def offer(which: np.ndarray, rows: np.ndarray, far: np.ndarray) -> None:
            name = np.broadcast_to(self.ids[rows], far.shape)
            far = np.where(name == own[which][:, None], np.inf, far)
            far, name = np.hstack([best[which], far]), np.hstack([names[which], name])
            order = np.lexsort((name, far), axis=1)[:, :k]
            best[which], names[which] = np.take_along_axis(far, order, 1), np.take_along_axis(name, order, 1)

        def visit(at: int, which: np.ndarray) -> None:
            if not len(which):
                return
            node = self.nodes[at]
            if len(node) == 1:
                for low in range(0, len(node[0]), 512):
                    rows = node[0][low : low + 512]
                    offer(which, rows, distances(queries[which], self.points[rows]))
                return
            vantage, radius, inner, outer = node
            far = distances(queries[which], self.points[vantage][None])
            offer(which, np.array([vantage]), far)
            far = far[:, 0]
            inside = far <= radius
            visit(inner, which[inside])
            visit(outer, which[~inside])
            # the other half, unless it is too far to hold a better one
            open_ = np.abs(far - radius) * (1 - 1e-12) <= factor * best[which, k - 1]
            visit(outer, which[inside & open_])
            visit(inner, which[~inside & open_])

        if len(self.points):
            for low in range(0, len(queries), 1024):
                visit(self.root, np.arange(low, min(low + 1024, len(queries))))
        return best, np.where(np.isinf(best), -1, names)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    out = np.empty((len(a), len(b)))
    for low in range(0, len(a), 64):
        gap = a[low : low + 64, None, :] - b[None, :, :]
        out[low : low + 64] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
    return out


def usable(vector: Column) -> Column:
    """Not null, nor empty, nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _search(k: int, factor: float, leaf: int):
    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by shard and size of vector; in each, vectors first and then queries."""
        group, ids, points, tree = None, [], [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in (0, 1, 2)], axis=1)
            edge = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            for low, high in zip([0, *edge], [*edge, len(keys)]):
                part, (shard, size, asks) = batch.slice(low, high - low), keys[low]
                if group != (shard, size):
                    group, ids, points, tree = (shard, size), [], [], None
                names, vectors = part.column(3).to_numpy(), matrix(part.column(4))
                if not asks:
                    ids.append(names)
                    points.append(vectors)
                    continue
                if not points:
                    continue
                if tree is None:
                    tree = Tree(np.concatenate(points), np.concatenate(ids), leaf)
                far, found = tree.search(vectors, names, k, factor)
                query, place = np.nonzero(np.isfinite(far))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[query]), pa.array(found[query, place]), pa.array(far[query, place])],
                    names=["query_id", "id", "score"],
                )

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding",
    k: int = K, factor: float = FACTOR, per_shard: int = PER_SHARD, leaf: int = LEAF,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest vectors found for each query, nearest first.

    A query doesn't find vectors of its own id. Vectors and queries that are null,
    zero, or hold a null or non-finite number take no part, nor do null ids; vectors
    of another length than the query's are not compared with it. Vectors that repeat
    are candidates of their own, queries with one id must be one row. A query without
    candidates gives no row. Finite components must not overflow when squared.
    """
    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        return rows.where(F.col("id").isNotNull() & usable(F.col("vector")))

    rows = clean(vectors)
    shards = max(1, -(-rows.count() // per_shard))
    size = F.size("vector").alias("size")
    dealt = rows.select(
        F.pmod(F.xxhash64(F.lit("shard"), "id"), F.lit(shards)).cast("int").alias("shard"), size, F.lit(0).alias("asks"), "id", "vector"
    )
    asked = clean(queries).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), size, F.lit(1).alias("asks"), "id", "vector"
    )
    both = dealt.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "size", "asks")
    found = store(both.mapInArrow(_search(k, factor, leaf), "query_id bigint, id bigint, score double"), "nearest")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")
