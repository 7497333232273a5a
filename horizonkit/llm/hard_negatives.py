"""Hard negatives by exact maximum inner product search in cover trees.

Each row's vector x is augmented to (x, sqrt(M**2 - |x|**2)), M the largest norm of its
tree, so all points lie on one sphere and an anchor (q, 0) meets larger inner products at
smaller angles. Rows are dealt into shards; each shard's task builds one cover tree:

* a node at level l covers its points within base**l of its centre; its children are
  centres of level l - 1, chosen farthest first (so more than base**(l - 1) apart) until
  they cover the points; levels at which one centre would cover all are skipped;
* the distance to the farthest point below a child, as measured, bounds the inner
  products below it from both sides: the angle between anchor and centre, less and plus
  the angle of that radius;
* the search of an anchor takes the node of highest upper bound first and skips nodes
  that hold no wanted label, lie wholly outside all its windows, or are below all its
  k-th best scores; leaves are verified in exact integers.

The best of all shards are merged per anchor. Results are exact and do not depend on the
number of shards."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_stream, parts, stored

#: A shard holds about SHARD_ROWS rows at most; fewer while partitions stand idle.
SHARD_ROWS, LEAST_ROWS = 65_536, 4_096
LEAF, BASE = 192, 1.2
#: Whole numbers below this are exact in double precision.
_EXACT = float(1 << 53)
_LONGEST = float(1 << 62)
#: Relative slack of the bounds: rounding of an angle near 0 is of the order 1e-8.
_SLACK = 1e-7
_MIXED = object()


@dataclass
class Node:
    """Points (positions) and their label if they share one. An inner node has the centres
    of its children and the cosine and sine of the angles of their radii; children of
    more than a leaf's points are nodes, of the others it holds the points (``small``)
    with the number of the child of each (``owner``)."""

    points: np.ndarray
    label: object
    nodes: dict | None = None
    centres: np.ndarray | None = None
    cos: np.ndarray | None = None
    sin: np.ndarray | None = None
    small: np.ndarray | None = None
    owner: np.ndarray | None = None


class CoverTree:
    """Cover tree of integer vectors ``x`` (as doubles) with their ids and labels."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, base: float = BASE, leaf: int = LEAF):
        norms = np.sqrt((x * x).sum(axis=1))
        self.x, self.ids, self.labels, self.leaf = x, ids, labels, leaf
        self.norm = max(float(norms.max(initial=0.0)), 1.0)
        if not self.norm < _LONGEST:
            raise OverflowError("a vector is too long for 64-bit scores")
        self.augmented = np.column_stack([x, np.sqrt(np.maximum(0.0, self.norm ** 2 - norms ** 2))])
        self.step = np.log(base)
        every = np.arange(len(x))
        self.root = self._node(every)
        start = self._distances(every, 0)
        todo = [(self.root, 0, start)]
        while todo:
            todo += self._split(*todo.pop())

    def _node(self, points: np.ndarray) -> Node:
        of = self.labels[points]
        return Node(points, of[0] if (of == of[0]).all() else _MIXED)

    def _distances(self, points: np.ndarray, centre: int) -> np.ndarray:
        away = self.augmented[points] - self.augmented[centre]
        return np.sqrt(np.einsum("ij,ij->i", away, away))

    def _split(self, node: Node, centre: int, away: np.ndarray) -> list:
        """Give a node its children; (child, centre, distances to it) of those to go on with."""
        points, radius = node.points, away.max()
        if len(points) <= self.leaf or radius <= _SLACK * self.norm:
            return []
        reach = np.exp(self.step * (np.ceil(np.log(radius) / self.step) - 1))
        reach = min(reach, 0.999 * radius)  # of the next level down
        nearest, owner, centres = away.copy(), np.zeros(len(points), np.int64), [centre]
        while nearest.max() > reach:
            new = int(points[nearest.argmax()])
            d = self._distances(points, new)
            closer = d < nearest
            nearest[closer], owner[closer] = d[closer], len(centres)
            centres.append(new)
        radii, count = np.zeros(len(centres)), np.bincount(owner, minlength=len(centres))
        np.maximum.at(radii, owner, nearest)
        sine = np.minimum(1.0, radii / (2 * self.norm))  # of half the angle
        node.centres, node.cos = self.augmented[centres], 1 - 2 * sine ** 2
        node.sin = 2 * sine * np.sqrt(1 - sine ** 2)
        held = count[owner] <= self.leaf
        node.small, node.owner, node.nodes, more = points[held], owner[held], {}, []
        for c in np.flatnonzero(count > self.leaf).tolist():
            mine = owner == c
            node.nodes[c] = self._node(points[mine])
            more.append((node.nodes[c], centres[c], nearest[mine]))
        return more

    def scores(self, query: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Inner products as exact whole numbers."""
        if self.norm * np.sqrt(query @ query) < _EXACT:
            return (self.x[points] @ query).astype(np.int64)
        whole = [int(v) for v in query]
        return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in self.x[points]], np.int64)

    def search(self, query: np.ndarray, own: int, label: int, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list:
        """Per window [low, high] the (score, id) of the k best rows of the same (or another)
        label, best first, ties to the smaller id. ``own`` is no candidate."""
        edge = float(np.sqrt(query @ query)) * self.norm
        slack = _SLACK * edge + 1e-6
        best: list[list] = [[] for _ in low]
        floor = low.astype(float)
        query_up = np.append(query, 0.0)
        heap, n = [(-np.inf, 0, -np.inf, self.root)], 0
        while heap:
            upper, _, lower, node = heapq.heappop(heap)
            if not ((-upper >= floor) & (lower <= high) & (low <= high)).any():
                continue
            if node.nodes is None:
                self._verify(query, own, label, same, low, high, k, best, floor, node.points)
                continue
            p = node.centres @ query_up
            side = np.sqrt(np.maximum(0.0, edge ** 2 - p ** 2))
            up = np.where(p >= edge * node.cos, edge, p * node.cos + side * node.sin) + slack
            down = np.where(-p >= edge * node.cos, -edge, p * node.cos - side * node.sin) - slack
            inside = ((up[:, None] >= floor) & (down[:, None] <= high) & (low <= high)).any(axis=1)
            self._verify(query, own, label, same, low, high, k, best, floor, node.small[inside[node.owner]])
            for c, child in node.nodes.items():
                if inside[c] and (child.label is _MIXED or (child.label == label) == same):
                    n += 1
                    heapq.heappush(heap, (-up[c], n, down[c], child))
        return best

    def _verify(self, query, own, label, same, low, high, k, best, floor, points) -> None:
        points = points[((self.labels[points] == label) == same) & (self.ids[points] != own)]
        if not len(points):
            return
        s, ids = self.scores(query, points), self.ids[points]
        for w in range(len(low)):
            hit = np.flatnonzero((s >= floor[w]) & (s <= high[w]) & (s >= low[w]))
            if not len(hit):
                continue
            top = hit[np.lexsort((ids[hit], -s[hit]))[:k]]
            best[w] = sorted(best[w] + list(zip(s[top].tolist(), ids[top].tolist())), key=lambda r: (-r[0], r[1]))[:k]
            if len(best[w]) == k:
                floor[w] = max(floor[w], best[w][-1][0])


_WIDE = (-(1 << 62), 1 << 62)


def quantised(vector: Column, scale: int = 256) -> Column:
    """Whole components floor(scale * x), in double precision (from 2**53 on, every double is whole)."""
    return F.transform(vector.cast("array<double>"), lambda v: F.when(F.abs(v * scale) < _EXACT, F.floor(v * scale).cast("double")).otherwise(v * scale))


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def _searched(rows: DataFrame, asked: DataFrame, shards: int, same: bool, k: int) -> DataFrame:
    """(anchor_id, window, id, score): the k best of each window in each shard. ``asked``:
    (shard, id, label, v, low, high), an anchor with its windows for a shard."""
    wide = rows.select("shard", F.lit(0).alias("kind"), "id", "label", "v", F.lit(None).cast("array<bigint>").alias("low"), F.lit(None).cast("array<bigint>").alias("high"))
    every = wide.unionByName(asked.withColumn("kind", F.lit(1))).withColumn("dim", F.size("v"))

    def fn(stream):
        at, trees, held = None, {}, {}
        for cols in stream:
            out: dict[str, list] = {"anchor_id": [], "window": [], "id": [], "score": []}
            for shard, kind, dim, key, label, v, low, high in zip(*(cols[c] for c in ("shard", "kind", "dim", "id", "label", "v", "low", "high"))):
                if shard != at:
                    at, trees, held = shard, {}, {}
                if kind == 0:
                    held.setdefault(dim, []).append((key, label, np.array(v, float)))
                    continue
                if dim in held:
                    ids, labels, x = zip(*held.pop(dim))
                    trees[dim] = CoverTree(np.array(x), np.array(ids, np.int64), np.array(labels, np.int64))
                if dim in trees:
                    found = trees[dim].search(np.array(v, float), key, label, same, np.array(low, np.int64), np.array(high, np.int64), k)
                    for w, best in enumerate(found):
                        for s, i in best:
                            for name, value in zip(out, (key, w, i, s)):
                                out[name].append(value)
            yield out

    dealt = every.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    return map_stream(dealt, fn, "anchor_id bigint, window int, id bigint, score bigint")


def hard_negatives(vectors: DataFrame, anchors: Column, k: int = 10, positives: int = 5, least: int = 30, most: int = 90,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each row that meets ``anchors`` (a condition on the table's columns) and each of its
    ``positives`` best rows of the same label, the first ``k`` rows of another label with
    least * positive_score <= 100 * negative_score <= most * positive_score. Scores are
    integer inner products of floor(scale * vector); higher first, ties to the smaller id.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite
    component take no part. Only vectors of the anchor's length are candidates. Of rows
    that share an id, the one of smallest label, then vector, stands for it. Anchors
    without positives, positives of negative score (an empty window) or without a row in
    the window give no rows; an empty table gives none. Other columns are not read, but
    by ``anchors``. A vector of length 2**62 or a score beyond 64 bits is an error."""
    fine = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & _usable(F.col(vector_col)))
    rows = fine.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                       quantised(F.col(vector_col), scale).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    rows = stored(rows.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("id", "r.*"), "negatives-rows")
    labels = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    shards = max(1, -(-total // SHARD_ROWS), min(parts(vectors), -(-total // LEAST_ROWS)))
    # the rows of a label lie in as few shards as hold them, so that positives are sought there only
    size = max(1, -(-total // shards))
    labels = stored(labels.select("label", F.ceil(F.col("n") / size).cast("int").alias("parts")), "negatives-labels")

    def shard(part: Column) -> Column:
        return F.pmod(F.xxhash64("label") + part, F.lit(shards)).cast("int")

    dealt = rows.join(labels, "label").select(shard(F.pmod(F.xxhash64("id"), F.col("parts"))).alias("shard"), "id", "label", "v")
    dealt = stored(dealt, "negatives-dealt")
    asked = rows.where("anchor").select("id", "label", "v")

    def wide(edge: int) -> Column:
        return F.array(F.lit(edge).cast("bigint"))

    near = (asked.join(labels, "label").select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
            .select(shard(F.col("part")).alias("shard"), "id", "label", "v", wide(_WIDE[0]).alias("low"), wide(_WIDE[1]).alias("high")))
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = _searched(dealt, near, shards, True, positives).withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    chosen = stored(found.select("anchor_id", (F.col("place") - 1).cast("int").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                    "negatives-positives")
    windows = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("window", "positive_score"))).alias("w"))  # ``positives`` entries
    far = asked.join(windows.withColumnRenamed("anchor_id", "id"), "id").select(
        "id", "label", "v", F.expr(f"transform(w, x -> cast(ceil(cast(x.positive_score as decimal(20, 0)) * {least} / 100) as bigint))").alias("low"),
        F.expr(f"transform(w, x -> cast(floor(cast(x.positive_score as decimal(20, 0)) * {most} / 100) as bigint))").alias("high"))
    far = far.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "*")
    each = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    hits = _searched(dealt, far, shards, False, k).withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k)
    return hits.join(chosen, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
