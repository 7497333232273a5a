"""Distributed exact quantiles equal the exact aggregate."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from horizonkit.functions.quantiles import exact_quantiles


@pytest.mark.parametrize("accuracy", [10_000, 40, 3])
def test_exact_quantiles_match_percentile(spark, accuracy):
    rng = np.random.default_rng(0)
    rows = [("a", float(v)) for v in rng.normal(size=3000)]
    rows += [("b", float(v)) for v in rng.integers(0, 7, size=500)]      # heavy ties
    rows += [("c", 5.0)] + [("c", None)] * 3                                # one value
    df = spark.createDataFrame(rows, "k string, v double")
    qs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", qs, accuracy).collect()}
    exp = {r["k"]: r for r in df.groupBy("k").agg(*[F.percentile("v", q).alias(f"e{i}")
                                                    for i, q in enumerate(qs)]).collect()}
    assert set(got) == set(exp)
    for k in exp:
        for i, q in enumerate(qs):
            assert abs(got[k][f"q{round(q * 1000):04d}"] - exp[k][f"e{i}"]) < 1e-12


def test_exact_quantiles_global(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    r = exact_quantiles(df, [], "v", [0.5, 0.25], names=["med", "p25"]).first()
    assert r["med"] == 5.0 and r["p25"] == 2.5
