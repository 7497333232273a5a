"""Approximate nearest neighbours with vantage-point trees, one per shard.

Vectors are dealt into shards by hash; each shard's task builds a tree (a vantage point
and the median distance to it part a node's points into inside and outside) and streams
the queries through it in blocks. A first descent to the nearest leaf gives each query a
bound; a second pass visits every child whose lower bound by the triangle inequality is
at most the best k-th distance so far, where the bound across the boundary to the other
child is held against only ``factor`` times that distance. Factor 1 is exact search,
smaller ones prune more. Distances are Euclidean in double precision on the original vectors.
The k best of all shards are then merged per query."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_stream, parts

#: A shard holds about SHARD_ROWS vectors at most; fewer while partitions stand idle.
SHARD_ROWS, LEAST_ROWS = 131_072, 2_048
LEAF, BLOCK = 128, 256
FACTOR = 0.7
_SLACK = 1e-9


@dataclass
class Node:
    """A leaf (point positions) or a vantage point with its two children and, of each
    child, the least and largest distance to the vantage point."""

    points: np.ndarray
    children: tuple | None = None


def build(x: np.ndarray, own: np.ndarray) -> Node:
    """Tree of the points x[own]; points all equally far from the vantage stay a leaf."""
    root = Node(own)
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.points) <= LEAF:
            continue
        at = (len(node.points) * 0x9E3779B1 >> 7) % len(node.points)
        vantage, rest = node.points[at], np.delete(node.points, at)
        d = np.sqrt(((x[rest] - x[vantage]) ** 2).sum(axis=1))
        middle = np.median(d)
        inside = d <= middle if (d > middle).any() else d < middle
        if not inside.any() or inside.all():
            continue
        node.points = np.array([vantage])
        node.children = tuple((Node(rest[m]), d[m].min(), d[m].max()) for m in (inside, ~inside))
        todo += [c for c, _, _ in node.children]
    return root


class Search:
    """The k nearest points of a block of queries in one tree."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
        self.x, self.ids, self.q, self.qid, self.k = x, ids, queries, query_ids, k
        self.bound = np.full(len(queries), np.inf)
        self.clear()

    def clear(self) -> None:
        self.best = np.full((len(self.q), self.k), np.inf)
        self.found = np.full((len(self.q), self.k), np.iinfo(np.int64).max)

    def distances(self, of: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.q[of][:, None, :] - self.x[points][None]) ** 2).sum(axis=2))

    def offer(self, of: np.ndarray, points: np.ndarray, d: np.ndarray) -> None:
        d = np.where(self.ids[points][None] == self.qid[of][:, None], np.inf, d)
        d = np.concatenate([self.best[of], d], axis=1)
        ids = np.concatenate([self.found[of], np.broadcast_to(self.ids[points], (len(of), len(points)))], axis=1)
        order = np.lexsort((ids, d), axis=-1)[:, :self.k]
        self.best[of], self.found[of] = np.take_along_axis(d, order, 1), np.take_along_axis(ids, order, 1)

    def scan(self, of: np.ndarray, node: Node) -> None:
        for i in range(0, len(node.points), LEAF):
            p = node.points[i:i + LEAF]
            self.offer(of, p, self.distances(of, p))

    def run(self, root: Node, factor: float) -> None:
        todo = [(root, np.arange(len(self.q)))]
        while todo:  # down to the leaf each query falls into
            node, of = todo.pop()
            if node.children is None:
                self.scan(of, node)
                continue
            d = self.distances(of, node.points)
            self.offer(of, node.points, d)
            (a, _, edge), (b, _, _) = node.children
            todo += [(c, of[m]) for c, m in ((a, d[:, 0] <= edge), (b, d[:, 0] > edge)) if m.any()]
        self.bound = self.best[:, -1].copy()
        self.clear()
        todo = [(root, np.arange(len(self.q)))]
        while todo:
            node, of = todo.pop()
            if node.children is None:
                self.scan(of, node)
                continue
            d = self.distances(of, node.points)
            self.offer(of, node.points, d)
            d, limit = d[:, 0], np.minimum(self.bound[of], self.best[of, -1]) + _SLACK * (1 + d[:, 0])
            for (child, least, most), side in zip(node.children, (1, -1)):
                across, back = (d - most, least - d)[::side]  # toward the other child; toward the vantage or away
                m = (across <= factor * limit) & (back <= limit)
                if m.any():
                    todo.append((child, of[m]))


def usable(vector: Column) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = FACTOR,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest vectors found (all, if
    fewer), nearest first, ties to the smaller id; score is the Euclidean distance.

    A query's own rows (equal id) are no candidates. Unusable vectors (see ``usable``)
    and rows with a null id take no part. Only vectors of the query's length are
    candidates. Of rows that share an id, each is a candidate, the nearest counts, and
    as a query the smallest vector stands for them. Empty tables give no rows."""
    def clean(df):
        return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
            F.col("id").isNotNull() & usable(F.col("v")))

    points, asked = clean(vectors), clean(queries).groupBy("id").agg(F.min("v").alias("v"))
    n = points.count()
    shards = max(1, -(-n // SHARD_ROWS), min(parts(vectors), -(-n // LEAST_ROWS)))
    dealt = points.select(F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "id", "v")
    every = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "id", "v")
    rows = dealt.union(every).select("shard", "kind", "id", "v", F.size("v").alias("dim"))

    def fn(stream):
        at, trees, held = None, {}, {}
        for cols in stream:
            marks = list(zip(cols["shard"], cols["kind"], cols["dim"]))
            edges = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
            for i, j in zip(edges[:-1], edges[1:]):
                shard, kind, dim = marks[i]
                if shard != at:
                    at, trees, held = shard, {}, {}
                v, ids = np.array(cols["v"][i:j], float), np.array(cols["id"][i:j], np.int64)
                if kind == 0:
                    held.setdefault(dim, []).append((v, ids))
                    continue
                if dim in held:
                    x, own = (np.concatenate([h[m] for h in held[dim]]) for m in (0, 1))
                    del held[dim]
                    order = np.lexsort((*x.T[::-1], own))
                    trees[dim] = (x[order], own[order], build(x[order], np.arange(len(own))))
                if dim not in trees:
                    continue
                x, own, root = trees[dim]
                for a in range(0, len(ids), BLOCK):
                    s = Search(x, own, v[a:a + BLOCK], ids[a:a + BLOCK], k)
                    s.run(root, factor)
                    q, r = np.nonzero(np.isfinite(s.best))
                    yield {"query_id": s.qid[q], "vec_id": s.found[q, r], "score": s.best[q, r]}

    found = map_stream(rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "dim"), fn,
                       "query_id bigint, vec_id bigint, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # at most k a shard
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
