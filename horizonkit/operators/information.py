"""Mutual information from nearest neighbours (P9), as distributed joins.

The estimator of Kraskov, Stögbauer and Grassberger: with r the distance (the larger of
both coordinates') to a point's k-th neighbour and n_x, n_y the points closer than r in
one coordinate (itself included), the information is psi(n) + psi(k) - mean(psi(n_x) +
psi(n_y)).

* Equal points are one row with a weight, so ties cost nothing and have r = 0.
* Neighbours: strips of equal depth in x, cells of equal depth in y within a strip. A
  cell's own points bound each point's r; only where that ball crosses into another cell
  is the point sent there, and the nearest of all visits count. This is exact.
* Marginal counts: values and interval ends of a coordinate in one order, with running
  counts per range and the counts of the ranges before it."""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import all_not_null
from ..session import materialize

CELL_ROWS = 1024
_BLOCK = 256
#: Points at the distance r itself are not closer, however x + r is rounded.
_SHORT = 1 - 1e-10


def digamma(x: Column) -> Column:
    """psi of a number of at least 1: recurrence to x + 6, then the asymptotic series."""
    z = x + 6
    series = F.log(z) - 1 / (2 * z) - 1 / (12 * z ** 2) + 1 / (120 * z ** 4) - 1 / (252 * z ** 6)
    return series - sum((1 / (x + i) for i in range(6)), F.lit(0.0))


def _nearest(x: np.ndarray, y: np.ndarray, w: np.ndarray, qx: np.ndarray, qy: np.ndarray, k: int, own: bool) -> list[list[float]]:
    """Per query the k least distances to points of weight w (each counted w times); with
    ``own`` query i is point i, which does not count once."""
    out = []
    most = min(len(x), k + 1)
    for i in range(0, len(qx), _BLOCK):
        d = np.maximum(np.abs(qx[i:i + _BLOCK, None] - x), np.abs(qy[i:i + _BLOCK, None] - y))
        times = np.broadcast_to(w, d.shape)
        if own:
            times = times.copy()
            times[np.arange(len(d)), np.arange(i, i + len(d))] -= 1
            d = np.where(times > 0, d, np.inf)
        at = np.argpartition(d, most - 1, axis=1)[:, :most]
        near, n = np.take_along_axis(d, at, 1), np.take_along_axis(times, at, 1)
        for row, c in zip(near, n):
            order = np.argsort(row, kind="stable")
            got = [v for v, t in zip(row[order].tolist(), c[order].tolist()) if math.isfinite(v) for _ in range(min(k, t))]
            out.append(got[:k])
    return out


def _edges(values: DataFrame, keys: Sequence[str], col: str, parts: int, name: str) -> DataFrame:
    at = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else None
    edges = F.array_distinct(F.percentile_approx(col, at, 10_000)) if parts > 1 else F.first(F.expr("cast(array() as array<double>)"))
    return values.groupBy(*keys).agg(edges.alias(name))


def _range(edges: Column, value: Column) -> Column:
    """Number of the range between ``edges`` that a value falls into."""
    return F.size(F.filter(edges, lambda e: e < value))


def _radii(points: DataFrame, parts: int, k: int) -> DataFrame:
    """(feature, x, y, w, r): distance of each distinct point to its k-th neighbour."""
    strips = materialize(_edges(points, ["feature"], "x", parts, "xe"))
    inside = points.join(strips, "feature").withColumn("strip", _range(F.col("xe"), F.col("x"))).drop("xe")
    cells = materialize(_edges(inside, ["feature", "strip"], "y", parts, "ye"))
    placed = materialize(inside.join(cells, ["feature", "strip"]).withColumn("cell", _range(F.col("ye"), F.col("y"))).drop("ye"))

    def local(part: pd.DataFrame) -> pd.DataFrame:
        x, y, w = (part[c].to_numpy() for c in ("x", "y", "w"))
        return part.assign(near=pd.Series(_nearest(x, y, w, x, y, k, True), part.index, object))

    fields = "feature string, strip int, cell int, x double, y double, w long, near array<double>"
    names = ["feature", "strip", "cell", "x", "y", "w"]
    first = materialize(placed.select(names).groupBy("feature", "strip", "cell").applyInPandas(local, fields))
    bound = F.when(F.size("near") >= k, F.element_at("near", k)).otherwise(F.lit(float("inf")))
    asked = first.withColumn("r", bound).where("r > 0").join(strips, "feature")
    asked = asked.select("feature", "x", "y", "w", "r", F.col("strip").alias("s0"), F.col("cell").alias("c0"),
                         F.explode(F.sequence(_range(F.col("xe"), F.col("x") - F.col("r")), _range(F.col("xe"), F.col("x") + F.col("r")))).alias("strip"))
    asked = asked.join(cells, ["feature", "strip"]).select(
        "feature", "strip", F.explode(F.sequence(_range(F.col("ye"), F.col("y") - F.col("r")), _range(F.col("ye"), F.col("y") + F.col("r")))).alias("cell"),
        "x", "y", "w", "s0", "c0").where("strip <> s0 or cell <> c0").drop("s0", "c0")

    def visit(part: pd.DataFrame) -> pd.DataFrame:
        here, guests = part[~part["guest"]], part[part["guest"]]
        x, y, w = (here[c].to_numpy() for c in ("x", "y", "w"))
        near = _nearest(x, y, w, guests["x"].to_numpy(), guests["y"].to_numpy(), k, False) if len(here) else [[] for _ in range(len(guests))]
        return guests[names].assign(near=pd.Series(near, guests.index, object))

    both = placed.select(names).withColumn("guest", F.lit(False)).unionByName(asked.withColumn("guest", F.lit(True)))
    more = both.groupBy("feature", "strip", "cell").applyInPandas(visit, fields)
    every = first.unionByName(more).groupBy("feature", "x", "y", "w").agg(F.sort_array(F.flatten(F.collect_list("near"))).alias("near"))
    return every.where(F.size("near") >= k).select("feature", "x", "y", "w", F.element_at("near", k).alias("r"))


def _within(radii: DataFrame, col: str, parts: int, name: str) -> DataFrame:
    """(feature, x, y, name): weight of the points closer than r in ``col`` (r = 0: equal)."""
    v, tie = F.col(col), F.col("r") == 0
    r = F.col("r") * _SHORT
    # in the order of values, tag 0 stands before the points of its value (tag 1), tag 2 after them
    ends = F.array(F.struct((v - r).alias("v"), F.when(tie, 0).otherwise(2).alias("tag"), F.lit(-1).alias("sign")),
                   F.struct((v + r).alias("v"), F.when(tie, 2).otherwise(0).alias("tag"), F.lit(1).alias("sign")))
    asked = radii.select("feature", "x", "y", F.lit(0).cast("long").alias("w"), F.inline(ends))
    points = radii.select("feature", "x", "y", "w", v.alias("v"), F.lit(1).alias("tag"), F.lit(0).alias("sign"))
    edges = _edges(radii, ["feature"], col, parts * parts, "e")
    both = asked.unionByName(points).join(edges, "feature").withColumn("b", _range(F.col("e"), F.col("v"))).drop("e")
    totals = both.groupBy("feature", "b").agg(F.sum("w").alias("t"))
    before = F.coalesce(F.sum("t").over(Window.partitionBy("feature").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select("feature", "b", before.alias("before"))
    run = F.sum("w").over(Window.partitionBy("feature", "b").orderBy("v", "tag"))
    counted = both.withColumn("run", run).where("sign <> 0").join(totals, ["feature", "b"])
    return counted.groupBy("feature", "x", "y").agg(F.sum(F.col("sign") * (F.col("run") + F.col("before"))).alias(name))


def knn_mutual_info(df: DataFrame, feature_cols: Sequence[str], target: str, k: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(feature, n, mutual_info) of each feature with the target, both divided by their
    standard deviation. Rows with a null in any of the columns are left out. A constant
    feature or target, and a sample of at most k rows, have information 0."""
    names = list(feature_cols)
    d = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*names, target])]).where(all_not_null([*names, target])))
    size = d.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(c).alias(c) for c in dict.fromkeys([*names, target])]).first()
    scale = {c: size[c] if size[c] else 1.0 for c in [*names, target]}
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(c) / scale[c]).alias("x")) for c in names])
    points = materialize(d.select((F.col(target) / scale[target]).alias("y"), F.inline(pairs)).groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("w")))
    parts = max(1, math.ceil(math.sqrt(size.n / cell_rows)))
    radii = materialize(_radii(points, parts, k))
    both = radii.join(_within(radii, "x", parts, "nx"), ["feature", "x", "y"]).join(_within(radii, "y", parts, "ny"), ["feature", "x", "y"])
    psi = F.sum(F.col("w") * (digamma(F.col("nx").cast("double")) + digamma(F.col("ny").cast("double")))) / F.sum("w")
    n = F.sum("w")
    info = both.groupBy("feature").agg(n.alias("n"), F.greatest(F.lit(0.0), digamma(n.cast("double")) + digamma(F.lit(float(k))) - psi).alias("mutual_info"))
    every = df.sparkSession.createDataFrame([(c, size[c] is not None and size[c] > 0 and bool(size[target])) for c in names], "feature string, varies boolean")
    return every.join(info, "feature", "left").select("feature", F.lit(size.n).cast("long").alias("n"),
                                                      F.when(F.col("varies"), F.coalesce("mutual_info", F.lit(0.0))).otherwise(0.0).alias("mutual_info"))
