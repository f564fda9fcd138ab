"""Nearest neighbours through vantage-point trees, one per shard.

Rows are dealt to shards of about ``shard_rows`` rows by a hash. In a shard, a tree halves the rows at
the median distance from a vantage point, down to leaves. Queries of a block first go down to the leaf
on their own side, for a first k-th best distance, and then through the tree together: at each vantage
point a query looks at the side it is not on only if ``factor`` times the gap between its distance and
the median is not above its k-th best distance so far. Factor one restores exact search; a larger one skips more. The best k of all shards are merged.

Queries are rows too, so they come in blocks of ``block_rows``; each task has one shard and one block.
Number of shards and blocks follow from the row counts.

Vectors that are null, zero, or hold null or non-finite components take no part. Vectors of different
lengths are never compared. Rows with the same vec_id as the query are the query's own; other rows
that repeat a vec_id are candidates of their own, equal ones included. Ties go to the smaller vec_id.
Rows without vec_id take no part. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
FACTOR = 2.0
SHARD_ROWS = 20_000
BLOCK_ROWS = 5_000
LEAF = 64
SLACK = 1e-9  # of the squared lengths; far above the rounding of a product of vectors


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` to those of ``b`` beside them, from differences, in double precision."""
    d = a - b
    return np.sqrt(np.einsum("ij,ij->i", d, d))


class Tree:
    """Nodes are (vantage row, median, inside, outside) or the numbers of leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.ids, self.vectors, self.leaf = ids, vectors, leaf
        self.lengths = np.einsum("ij,ij->i", vectors, vectors)
        self.leaves: list[np.ndarray] = []
        self.root = self._build(np.argsort(ids, kind="stable"))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            self.leaves.append(rows)
            return len(self.leaves) - 1
        # The row farthest from the first one lies at the edge, which parts the rest best.
        d = distances(self.vectors[rows[:1]], self.vectors[rows])
        at = int(np.argmax(d))
        vantage, rows = rows[at], np.delete(rows, at)
        d = distances(self.vectors[vantage][None], self.vectors[rows])
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        return vantage, float(d[order[half]]), self._build(rows[order[:half]]), self._build(rows[order[half:]])

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids of the best k of each query; infinite distance where there are fewer."""
        best = np.full((len(queries), k), np.inf)
        near = np.full((len(queries), k), np.iinfo(np.int64).max)
        length = np.einsum("ij,ij->i", queries, queries)

        def add(at: np.ndarray, place: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
            """Merge rows[i] at distance d[i] into the best of query at[place[i]]."""
            other = self.ids[rows] != ids[at[place]]
            place, rows, d = place[other], rows[other], d[other]
            if not len(place):
                return
            hit, place = np.unique(place, return_inverse=True)
            own = at[hit]
            who = np.concatenate((np.repeat(np.arange(len(own)), k), place))
            all_d = np.concatenate((best[own].ravel(), d))
            all_i = np.concatenate((near[own].ravel(), self.ids[rows]))
            order = np.lexsort((all_i, all_d, who))
            start = np.searchsorted(who[order], np.arange(len(own)))
            first = order[start[:, None] + np.arange(k)]
            best[own], near[own] = all_d[first], all_i[first]

        def leaf(rows: np.ndarray, at: np.ndarray) -> None:
            """A product of all queries and rows leaves few pairs, whose distances are then worked out exactly."""
            if not len(at) or not len(rows):
                return
            squares = length[at][:, None] + self.lengths[rows][None, :]
            rough = squares - 2 * (queries[at] @ self.vectors[rows].T)
            place, column = np.nonzero(rough <= best[at, -1][:, None] ** 2 + SLACK * squares)
            add(at, place, rows[column], distances(queries[at[place]], self.vectors[rows[column]]))

        home = np.full(len(queries), -1)

        def descend(node, at: np.ndarray) -> None:
            """To the leaf on the query's own side all the way, for a first k-th best distance."""
            if not len(at):
                return
            if not isinstance(node, tuple):
                home[at] = node
                leaf(self.leaves[node], at)
                return
            vantage, median, inside, outside = node
            near_side = distances(queries[at], self.vectors[vantage][None]) < median
            descend(inside, at[near_side])
            descend(outside, at[~near_side])

        def visit(node, at: np.ndarray) -> None:
            """All queries that a node may still serve, together."""
            if not len(at):
                return
            if not isinstance(node, tuple):
                leaf(self.leaves[node], at[home[at] != node])
                return
            vantage, median, inside, outside = node
            d = distances(queries[at], self.vectors[vantage][None])
            close = np.flatnonzero(d <= best[at, -1])
            add(at, close, np.full(len(close), vantage), d[close])
            gap = d - median
            for child, side in ((inside, gap < 0), (outside, gap >= 0)):
                # A hair is added to the reach, so that rounding never hides a tie.
                visit(child, at[side | (factor * np.abs(gap) <= best[at, -1] * (1 + 1e-12))])

        every = np.arange(len(queries))
        descend(self.root, every)
        visit(self.root, every)
        return best, near


def valid(vector: str = "embedding") -> Column:
    v = F.col(vector)
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & fit & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(t: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    flat = t.column("embedding").combine_chunks().flatten().to_numpy().astype(np.float64)
    return t.column("vec_id").to_numpy().astype(np.int64), flat.reshape(-1, dim)


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows nearest to each row of ``queries``, both (vec_id, embedding)."""
    if factor < 1:
        raise ValueError("factor is 1 (exact) or more")
    own = rows.where(valid() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), "embedding")
    asked = queries.where(valid() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), "embedding")
    asked = asked.dropDuplicates(["vec_id"])
    shards = max(1, math.ceil(own.count() / shard_rows))
    blocks = max(1, math.ceil(asked.count() / block_rows))
    dealt = own.withColumn("dim", F.size("embedding")).withColumn(
        # Hashed with the vector, so that rows of one vec_id spread too.
        "shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int")
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = asked.withColumn("dim", F.size("embedding")).withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    ).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        dim = key[0].as_py()
        ids, vectors = _matrix(left, dim)
        asked_ids, points = _matrix(right, dim)
        d, near = Tree(ids, vectors).search(asked_ids, points, k, factor)
        found = np.isfinite(d)
        at = np.nonzero(found)[0]
        return pa.table([pa.array(asked_ids[at]), pa.array(near[found]), pa.array(d[found])], names=names)

    grouped = dealt.groupBy("dim", "shard", "block").cogroup(sent.groupBy("dim", "shard", "block"))
    found = grouped.applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
