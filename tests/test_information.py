"""Nearest-neighbour mutual information against all pairs, with ties, for any cell size."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from horizonkit.operators.information import digamma, knn_mutual_info


def psi(n):
    return sum(1 / i for i in range(1, int(n))) - 0.57721566490153286


def plain(x, y, k=3):
    x, y = x / x.std(), y / y.std()
    total = 0.0
    for i in range(len(x)):
        d = np.sort(np.maximum(np.abs(x - x[i]), np.abs(y - y[i])))  # itself first
        r = d[k] * (1 - 1e-10)
        nx = (x == x[i]).sum() if r == 0 else ((x < x[i] + r) & (x > x[i] - r)).sum()
        ny = (y == y[i]).sum() if r == 0 else ((y < y[i] + r) & (y > y[i] - r)).sum()
        total += psi(nx) + psi(ny)
    return max(0.0, psi(len(x)) + psi(k) - total / len(x))


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(3)
    n = 700
    y = r.normal(size=n)
    cols = {"linear": y + 0.3 * r.normal(size=n), "square": y ** 2, "free": r.normal(size=n), "coarse": np.round(2 * y) / 2,
            "flag": (y > 0.5).astype(float), "lumps": np.where(r.random(n) < .4, 7.0, y + r.normal(size=n)), "heavy": r.standard_cauchy(size=n) * y, "flat": np.ones(n)}
    y = np.where(r.random(n) < .3, 1.25, y)  # a third of the target is one value
    return cols, y, spark.createDataFrame([(float(y[i]), *(float(v[i]) for v in cols.values())) for i in range(n)], ["y", *cols])


@pytest.mark.parametrize("cell_rows,k", [(10_000, 3), (60, 3), (12, 5)])
def test_equals_all_pairs_for_any_cells(data, cell_rows, k):
    cols, y, df = data
    got = {r.feature: r for r in knn_mutual_info(df, list(cols), "y", k, cell_rows).collect()}
    assert set(got) == set(cols) and got["flat"].mutual_info == 0.0
    for c, x in cols.items():
        assert got[c].n == len(y)
        if c != "flat":
            assert got[c].mutual_info == pytest.approx(plain(x, y, k), abs=1e-7), c
    assert got["linear"].mutual_info > got["free"].mutual_info + 0.3


def test_small_null_and_empty(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 1.0), (4.0, 4.0)], "x double, y double")
    assert [(r.n, r.mutual_info) for r in knn_mutual_info(df, ["x"], "y").collect()] == [(3, 0.0)]
    assert [(r.n, r.mutual_info) for r in knn_mutual_info(df.limit(0), ["x"], "y").collect()] == [(0, 0.0)]
    v = spark.range(1, 40).select(digamma(F.col("id").cast("double")).alias("p"), "id").collect()
    assert all(math.isclose(r.p, psi(r.id), abs_tol=1e-9) for r in v)
