"""Tree attributions against the definition over all feature subsets."""
import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from horizonkit.operators.attribution import base_value, influence, saved_leaves, tree_contributions


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(500, 4))
    kind = r.integers(0, 4, size=500)
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0, 2 * x[:, 2], -1) + np.where(kind % 2, 4, 0) + r.normal(size=500) * .1
    df = spark.createDataFrame([(i, *map(float, x[i]), f"k{kind[i]}", float(y[i])) for i in range(500)], "id long, a double, b double, c double, d double, kind string, y double")
    df = StringIndexer(inputCol="kind", outputCol="kind_idx").fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "c", "d", "kind_idx"], outputCol="features").transform(df).persist()


def holds(leaf, k, v):
    return leaf.low[k] < v <= leaf.high[k] and (leaf.allowed[k] is None or v in leaf.allowed[k])


def expected(leaves, x, known):
    """Prediction with only the features ``known``."""
    total = 0.0
    for leaf in leaves:
        p = leaf.value
        for k, i in enumerate(leaf.features):
            p *= holds(leaf, k, x[i]) if i in known else leaf.share[k]
        total += p
    return total


def subsets(leaves, x):
    n, out = len(x), []
    for i in range(n):
        rest, phi = [j for j in range(n) if j != i], 0.0
        for size in range(n):
            for s in combinations(rest, size):
                w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                phi += w * (expected(leaves, x, {*s, i}) - expected(leaves, x, set(s)))
        out.append(phi)
    return out


@pytest.mark.parametrize("make", [lambda: DecisionTreeRegressor(labelCol="y", maxDepth=4, seed=1), lambda: GBTRegressor(labelCol="y", maxIter=4, maxDepth=4, seed=1)])
def test_equals_all_subsets_and_adds_up(spark, rows, make):
    learner = make()
    model = learner.fit(rows)
    leaves = saved_leaves(spark, model)
    got = {r.id: r for r in tree_contributions(model, rows, ["id"]).collect()}
    for r in model.transform(rows).collect():
        assert got[r.id].base + sum(got[r.id].contributions) == pytest.approx(r.prediction, abs=1e-9)
        if r.id < 12:
            assert np.allclose(got[r.id].contributions, subsets(leaves, r.features.toArray()), atol=1e-9)
    mean = model.transform(rows).agg(F.avg("prediction")).first()[0]
    if isinstance(learner, DecisionTreeRegressor):
        assert base_value(leaves) == pytest.approx(mean, abs=1e-9)
    top = influence(tree_contributions(model, rows, ["id"]), ["a", "b", "c", "d", "kind_idx"]).collect()
    assert [r.feature for r in top][0] == "a" and [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    assert sum(r.mean_abs for r in top) > 0 and top[-1].feature == "d"
    assert tree_contributions(model, rows.limit(0), ["id"]).collect() == []
