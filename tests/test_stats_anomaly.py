"""ACF/PACF/Ljung–Box/decomposition and anomaly rules (E*, A*)."""
import datetime as dt

import numpy as np
import pandas as pd

from horizonkit.operators import anomaly as A
from horizonkit.operators import profile as P
from horizonkit.operators import stats as S

T0 = dt.datetime(2020, 1, 1)


def daily(spark, vals, series="s"):
    return spark.createDataFrame([(series, T0 + dt.timedelta(days=i), None if v is None else float(v))
                                  for i, v in enumerate(vals)], "series_id string, ts timestamp_ntz, y double")


def np_acf(x, k):
    x = np.asarray(x) - np.mean(x)
    return np.array([np.sum(x[j:] * x[:len(x) - j]) / np.sum(x * x) for j in range(k + 1)])


def test_acf_and_ljung_box(spark):
    rng = np.random.default_rng(1)
    x = np.cumsum(rng.normal(size=300)) * 0.1 + np.sin(np.arange(300) / 3)
    a = S.acf(daily(spark, x), "y", 10, bucket_steps=64).orderBy("lag").collect()
    assert np.allclose([r["acf"] for r in a], np_acf(x, 10), atol=1e-10)
    lb = {r["lag"]: r for r in S.ljung_box(S.acf(daily(spark, x), "y", 10), (5, 10)).collect()}
    r = np_acf(x, 10)
    q5 = 300 * 302 * sum(r[k] ** 2 / (300 - k) for k in range(1, 6))
    assert abs(lb[5]["lb_stat"] - q5) < 1e-6 and lb[5]["lb_pvalue"] < 0.05


def test_pacf_ar1(spark):
    rng = np.random.default_rng(2)
    x = [0.0]
    for _ in range(2000):
        x.append(0.7 * x[-1] + rng.normal())
    p = {r["lag"]: r["pacf"] for r in S.pacf(S.acf(daily(spark, x), "y", 5)).collect()}
    assert abs(p[1] - 0.7) < 0.05 and abs(p[3]) < 0.08


def test_decompose_recovers_weekly_pattern(spark):
    pattern = [0, 1, 2, 3, 2, 1, -9]
    x = [10 + pattern[i % 7] for i in range(70)]
    d = S.decompose(daily(spark, x), "y", 7).orderBy("ts").collect()
    assert d[0]["trend"] is None and abs(d[10]["trend"] - 10) < 1e-9
    assert all(abs(r["resid"]) < 1e-9 for r in d if r["resid"] is not None)


def test_zscore_and_rolling_iqr_match_pandas(spark):
    rng = np.random.default_rng(3)
    x = list(rng.normal(size=120))
    x[50] = 8.0
    x[70] = None
    df = daily(spark, x)
    z = {r["ts"]: r for r in A.zscore(df).collect()}
    assert z[T0 + dt.timedelta(days=50)]["zscore_flag"] and not z[T0 + dt.timedelta(days=70)]["zscore_flag"]
    q = A.rolling_iqr(df, bucket_steps=40).orderBy("ts").collect()
    s = pd.Series([np.nan if v is None else v for v in x])
    q1 = s.rolling(30, min_periods=10).quantile(0.25)
    q3 = s.rolling(30, min_periods=10).quantile(0.75)
    for i, r in enumerate(q):
        if np.isnan(q1[i]):
            assert r["q1"] is None
        else:
            assert abs(r["q1"] - q1[i]) < 1e-9 and abs(r["q3"] - q3[i]) < 1e-9
    assert q[50]["iqr_flag"]


def test_consensus_needs_two(spark):
    a = spark.createDataFrame([("s", T0, True), ("s", T0 + dt.timedelta(days=1), True)],
                              "series_id string, ts timestamp_ntz, f1 boolean")
    b = spark.createDataFrame([("s", T0, True)], "series_id string, ts timestamp_ntz, f2 boolean")
    c = A.consensus([a, b], ["f1", "f2"]).collect()
    assert [(r["ts"], r["n_methods_flagged"]) for r in c] == [(T0, 2)]


def test_holiday_calendar(spark):
    years = spark.createDataFrame([(2007,), (2010,)], "year int")
    cal = {(r["day"].date(), r["holiday"]) for r in P.holiday_calendar(years).collect()}
    assert (dt.date(2007, 4, 9), "Easter Monday") in cal
    assert (dt.date(2010, 5, 13), "Ascension") in cal
    assert (dt.date(2010, 5, 24), "Whit Monday") in cal
    assert (dt.date(2007, 7, 14), "Bastille Day") in cal


def test_isolation_forest_flags_outlier(spark):
    rng = np.random.default_rng(4)
    rows = [("s", T0 + dt.timedelta(days=i), float(rng.normal()), float(rng.normal())) for i in range(400)]
    rows[123] = ("s", rows[123][1], 9.0, -9.0)
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, a double, b double")
    out = A.isolation_forest(df, ["a", "b"], contamination=0.01, n_trees=20, sample_size=64)
    flagged = {r["ts"] for r in out.where("iforest_flag").collect()}
    assert rows[123][1] in flagged and len(flagged) <= 8


def test_constant_series_has_undefined_acf_not_an_error(spark):
    a = S.acf(daily(spark, [3.0] * 50), "y", 5).collect()
    assert all(r["acf"] is None for r in a)
    lb = S.ljung_box(S.acf(daily(spark, [1.0, 2.0, 3.0]), "y", 5), (5,)).collect()
    assert len(lb) == 1


def test_forest_flags_do_not_depend_on_partitions(spark):
    import datetime as dt
    import random
    from horizonkit.operators import anomaly as AN
    r = random.Random(1)
    rows = [("s", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), r.gauss(0, 1), r.gauss(0, 1)) for i in range(3000)]
    for n_trees in (20, 60):  # fewer and more than rows / sample size
        got = []
        for parts in (1, 7):
            r.shuffle(rows)
            df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, a double, b double").repartition(parts)
            got.append({(x.ts, x.iforest_score) for x in AN.isolation_forest(df, ["a", "b"], n_trees=n_trees, sample_size=64).where("iforest_flag").collect()})
        assert len(got[0]) > 30 and {t for t, _ in got[0]} == {t for t, _ in got[1]}
