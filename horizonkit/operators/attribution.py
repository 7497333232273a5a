"""Additive attributions of boosted trees (P8): how much each feature moves a prediction.

The exact Shapley values of a tree, with unseen features averaged by the training rows
below each branch. A leaf's value is shared among the features of its path: those whose
conditions a row meets and the weights of the branches taken otherwise. The values of a
row add up to its prediction less the mean prediction.

The trees are read from the saved model as a small table and sent to the tasks as flat
arrays (rounds x nodes); rows are worked on in blocks, one leaf at a time for all rows."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

_ROWS = 4096


@dataclass
class Leaf:
    """A leaf's value (times its tree's weight) and, per feature on its path, the index,
    the bounds low < x <= high, the categories allowed (or None), and the share of
    training rows that the feature's branches keep."""

    value: float
    features: list[int]
    low: list[float]
    high: list[float]
    allowed: list[set | None]
    share: list[float]


def saved_leaves(spark: SparkSession, model) -> list[Leaf]:
    """Leaves of a fitted tree ensemble or tree (its saved node table is read back)."""
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("treeID", "nodeData.*")
        weights = list(model.treeWeights)
    else:
        nodes, weights = nodes.withColumn("treeID", F.lit(0)), [1.0]
    trees: dict[int, dict] = {}
    for r in nodes.select("treeID", "id", "prediction", "rawCount", "leftChild", "rightChild", "split").collect():  # rounds x nodes of a tree
        trees.setdefault(r.treeID, {})[r.id] = r
    out = []
    for t, tree in trees.items():
        todo = [(0, {})]
        while todo:
            at, path_to = todo.pop()
            r = tree[at]
            if r.leftChild < 0:
                f = sorted(path_to)
                out.append(Leaf(r.prediction * weights[t], f, *([path_to[i][k] for i in f] for k in range(4))))
                continue
            i, values = r.split.featureIndex, list(r.split.leftCategoriesOrThreshold)
            for child, left in ((r.leftChild, True), (r.rightChild, False)):
                low, high, allowed, share = path_to.get(i, (-math.inf, math.inf, None, 1.0))
                if r.split.numCategories < 0:
                    low, high = (low, min(high, values[0])) if left else (max(low, values[0]), high)
                else:
                    side = set(values) if left else set(map(float, range(r.split.numCategories))) - set(values)
                    allowed = side if allowed is None else allowed & side
                todo.append((child, {**path_to, i: (low, high, allowed, share * tree[child].rawCount / r.rawCount)}))
    return out


def base_value(leaves: Sequence[Leaf]) -> float:
    """Mean prediction over the training rows of the branches."""
    return sum(x.value * math.prod(x.share) for x in leaves)


def contributions(leaves: Sequence[Leaf], x: np.ndarray) -> np.ndarray:
    """Shapley values of the columns for each row of ``x``."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        m = len(leaf.features)
        met = np.empty((len(x), m))
        for k, (i, low, high, allowed) in enumerate(zip(leaf.features, leaf.low, leaf.high, leaf.allowed)):
            v = x[:, i]
            met[:, k] = (v > low) & (v <= high) & (True if allowed is None else np.isin(v, list(allowed)))
        for k, i in enumerate(leaf.features):
            # sums over the sets of other features by their size: known ones count what the
            # row meets, unknown ones their share
            by_size = [np.ones(len(x))]
            for j in range(m):
                if j == k:
                    continue
                known = [np.zeros(len(x)), *(s * met[:, j] for s in by_size)]
                by_size = [a + b for a, b in zip([*(s * leaf.share[j] for s in by_size), np.zeros(len(x))], known)]
            total = sum(s / (m * math.comb(m - 1, size)) for size, s in enumerate(by_size))
            out[:, i] += leaf.value * (met[:, k] - leaf.share[k]) * total
    return out


def tree_contributions(model, rows: DataFrame, keep: Sequence[str], features: str = "features") -> DataFrame:
    """(keep, base, contributions) of each row with a ``features`` vector: the mean
    prediction and one value per feature; base plus their sum is the prediction."""
    spark = rows.sparkSession
    leaves = saved_leaves(spark, model)
    sent, base = spark.sparkContext.broadcast(leaves), base_value(leaves)
    x = rows.select(*keep, vector_to_array(features).alias("_x"))
    schema = T.StructType([*(f for f in x.schema.fields if f.name != "_x"), T.StructField("base", T.DoubleType()), T.StructField("contributions", T.ArrayType(T.DoubleType()))])

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for i in range(0, len(whole), _ROWS):
                part = whole.iloc[i:i + _ROWS]
                values = contributions(sent.value, np.array(part["_x"].tolist(), float))
                yield part.drop(columns="_x").assign(base=base, contributions=list(values))

    return x.mapInPandas(fn, schema)


def influence(contributed: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, mean_abs, mean, rank) over all rows of ``tree_contributions``."""
    each = contributed.select(F.posexplode("contributions").alias("i", "v")).groupBy("i").agg(F.avg(F.abs("v")).alias("mean_abs"), F.avg("v").alias("mean"))
    named = each.select(F.get(F.array(*map(F.lit, names)), F.col("i")).alias("feature"), "mean_abs", "mean")
    best = F.sort_array(F.collect_list(F.struct((-F.col("mean_abs")).alias("o"), "feature", "mean_abs", "mean")))  # one row per feature
    ranked = named.agg(best.alias("b")).select(F.posexplode("b").alias("i", "b"))
    return ranked.select("b.feature", "b.mean_abs", "b.mean", (F.col("i") + 1).alias("rank"))
