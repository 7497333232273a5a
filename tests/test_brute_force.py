"""Cross-checks against pandas / plain-Python reference computations on
random series with gaps (small fixtures; the registered queries are checked
against DuckDB separately)."""
import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from horizonkit.operators import backtest as B
from horizonkit.operators import features as FE
from horizonkit.operators import grid as G

T0 = dt.datetime(2021, 3, 1)


def gappy(n, seed, p_gap=0.08, long_gaps=((100, 300), (500, 505))):
    rnd = random.Random(seed)
    vals = [rnd.uniform(0, 5) for _ in range(n)]
    for i in range(n):
        if rnd.random() < p_gap:
            for j in range(i, min(n, i + rnd.randint(1, 4))):
                vals[j] = None
    for a, b in long_gaps:
        for j in range(a, min(n, b)):
            vals[j] = None
    vals[0] = vals[0] if seed % 2 else None
    return vals


def sdf(spark, vals, minutes=True):
    step = dt.timedelta(minutes=1) if minutes else dt.timedelta(hours=1)
    return spark.createDataFrame([("s", T0 + i * step, v) for i, v in enumerate(vals)],
                                 "series_id string, ts timestamp_ntz, y double")


def col_of(df, c="y"):
    return [r[c] for r in df.orderBy("ts").collect()]


def same(a, b, tol=1e-9):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if x is None or (isinstance(x, float) and np.isnan(x)):
            assert y is None or np.isnan(y), (x, y)
        else:
            assert y is not None and not np.isnan(y) and abs(x - y) < tol, (x, y)


def test_time_interpolation_matches_pandas(spark):
    for seed in (1, 2):
        vals = gappy(800, seed)
        s = pd.Series([np.nan if v is None else v for v in vals],
                      index=pd.date_range(T0, periods=len(vals), freq="min"))
        exp = s.interpolate(method="time", limit=180, limit_area="inside").tolist()
        got = col_of(G.interpolate_time(sdf(spark, vals), ["y"], step="minute", limit=180, bucket_steps=64))
        same(exp, got)


def test_positional_interpolation_matches_pandas(spark):
    vals = gappy(400, 3)
    s = pd.Series([np.nan if v is None else v for v in vals])
    exp = s.interpolate(limit_direction="both").tolist()
    same(exp, col_of(G.interpolate_position(sdf(spark, vals), ["y"], step="minute", bucket_steps=50)))


def test_rolling_and_lags_match_pandas(spark):
    vals = gappy(600, 4, p_gap=0.01, long_gaps=())
    s = pd.Series([np.nan if v is None else v for v in vals])
    out = FE.build_features(sdf(spark, vals, minutes=False), bucket_steps=200).orderBy("ts").toPandas()
    sh = s.shift(1)
    same(sh.rolling(24).mean().tolist(), out["y_roll_mean_24"].tolist())
    same(sh.rolling(24).std().tolist(), out["y_roll_std_24"].tolist())
    same(sh.rolling(168).max().tolist(), out["y_roll_max_168"].tolist())
    same(s.shift(168).tolist(), out["y_lag_168"].tolist())
    same((s.shift(1) - s.shift(25)).tolist(), out["y_diff_24"].tolist())


def test_resample_matches_pandas(spark):
    vals = gappy(60 * 30, 5)
    s = pd.Series([np.nan if v is None else v for v in vals], index=pd.date_range(T0, periods=len(vals), freq="min"))
    df = sdf(spark, vals).withColumn("t", F.col("y"))
    out = G.resample(df.where(F.col("y").isNotNull()), step="hour", mean_cols=["y"], sum_cols=["t"])
    got = out.orderBy("ts").toPandas()
    mean = s.resample("h").mean()
    tot = s.resample("h").sum(min_count=1)
    first, last = mean.first_valid_index(), mean.last_valid_index()
    same(mean[first:last].tolist(), got["y"].tolist())
    same(tot[first:last].tolist(), got["t"].tolist())


def test_backtest_matches_python_loop(spark):
    vals = gappy(24 * 20, 6, p_gap=0.05, long_gaps=())
    idx = [T0 + dt.timedelta(hours=i) for i in range(len(vals))]
    series = dict(zip(idx, vals))
    g = sdf(spark, vals, minutes=False)
    origins = [T0 + dt.timedelta(days=d) for d in range(0, 19)]
    odf = spark.createDataFrame([("s", o) for o in origins], "series_id string, origin timestamp_ntz")
    bt = B.run_backtest(g, odf, [B.naive(), B.daily_seasonal_naive(), B.weekly_seasonal_naive(),
                                 B.tiled_profile(24)], 24)
    got = {(r["origin"], r["method"], r["horizon_step"]): (r["actual"], r["forecast"]) for r in bt.collect()}
    exp = {}
    H = 24
    for o in origins:
        fut = [o + dt.timedelta(hours=h) for h in range(1, H + 1)]
        act = [series.get(t) for t in fut]
        looks = {"naive": [o] * H,
                 "daily_naive": [t - dt.timedelta(hours=24) for t in fut],
                 "weekly_naive": [t - dt.timedelta(hours=168) for t in fut],
                 "daily_profile": [o - dt.timedelta(hours=23) + dt.timedelta(hours=(h - 1) % 24)
                                   for h in range(1, H + 1)]}
        for m, lk in looks.items():
            if any(t not in series for t in lk):
                continue            # whole origin skipped for this method
            for h in range(H):
                exp[(o, m, h + 1)] = (act[h], series[lk[h]])
    assert got == exp
