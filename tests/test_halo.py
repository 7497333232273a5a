"""Bucketed (halo / two-phase) execution equals the plain per-series window."""
import datetime as dt
import random

from pyspark.sql import functions as F

from horizonkit.operators import features as FE
from horizonkit.operators import grid as G
from horizonkit.operators.halo import carry
from tests.conftest import hourly_rows


def _rows_with_nulls(n, seed, series="s"):
    rnd = random.Random(seed)
    return [(series, dt.datetime(2020, 1, 1) + dt.timedelta(hours=i),
             None if rnd.random() < 0.15 else rnd.uniform(0, 10)) for i in range(n)]


def _collect(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_halo_lags_rolling_equal_global(make_series):
    df = make_series(_rows_with_nulls(900, 1) + _rows_with_nulls(500, 2, "t"))
    cols = ["series_id", "ts", "y_lag_1", "y_lag_168", "y_roll_mean_24", "y_roll_std_168", "y_diff_24"]
    a = FE.build_features(df, bucket_steps=200)
    b = FE.build_features(df, bucketed=False)
    ra, rb = _collect(a, cols), _collect(b, cols)
    assert len(ra) == 1400
    for x, y in zip(ra, rb):
        for u, v in zip(x, y):
            assert (u is None and v is None) or (u == v) or abs(u - v) < 1e-9


def test_halo_forward_lead_equal_global(make_series):
    df = make_series(_rows_with_nulls(700, 3))
    a = FE.supervised(df, [1, 24, 168], bucket_steps=200)
    b = FE.supervised(df, [1, 24, 168], bucketed=False)
    cols = ["ts", "horizon", "y_target"]
    assert _collect(a, cols) == _collect(b, cols)


def test_carry_equals_brute_force(make_series):
    rows = _rows_with_nulls(1000, 4)
    df = make_series(rows)
    out = carry(df, ["series_id"], "ts", "hour", ["y"], bucket_steps=64).orderBy("ts").collect()
    vals = [r[2] for r in rows]
    for i, r in enumerate(out):
        assert r["_pos"] == i + 1
        prev = next((j for j in range(i, -1, -1) if vals[j] is not None), None)
        nxt = next((j for j in range(i, len(vals)) if vals[j] is not None), None)
        assert (r["_prev_y"] is None) == (prev is None)
        assert (r["_next_y"] is None) == (nxt is None)
        if prev is not None:
            assert r["_prev_y"]["pos"] == prev + 1 and r["_prev_y"]["v"] == vals[prev]
        if nxt is not None:
            assert r["_next_y"]["pos"] == nxt + 1 and r["_next_y"]["v"] == vals[nxt]


def test_gap_islands_across_buckets(make_series):
    rows = _rows_with_nulls(1000, 5)
    gaps = G.find_gaps(make_series(rows), ["y"], step="hour", bucket_steps=37).collect()
    vals = [r[2] for r in rows]
    expect, i = [], 0
    while i < len(vals):
        if vals[i] is None:
            j = i
            while j + 1 < len(vals) and vals[j + 1] is None:
                j += 1
            expect.append((rows[i][1], rows[j][1], j - i + 1))
            i = j + 1
        else:
            i += 1
    assert sorted((g["start"], g["end"], g["rows"]) for g in gaps) == sorted(expect)
    assert all(g["duration_seconds"] == g["rows"] * 3600 for g in gaps)


def test_grid_index_chunks(spark):
    b = spark.createDataFrame([("s", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 9))],
                              "series_id string, _lo timestamp_ntz, _hi timestamp_ntz")
    idx = G.grid_index(b, ["series_id"], "hour", chunk_steps=3).orderBy("ts").collect()
    assert [r["ts"].hour for r in idx] == list(range(10))


def test_halo_plan_partitions_by_bucket(make_series):
    df = make_series(hourly_rows(300))
    plan = FE.lags(df, ks=[1, 24])._jdf.queryExecution().executedPlan().toString()
    assert "_hk_b" in plan


def test_no_series_only_window_in_feature_plan(make_series):
    """Every Window operator of the feature plan is partitioned by (series, bucket)."""
    df = make_series(hourly_rows(400))
    plan = FE.build_features(df)._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in plan.splitlines() if "Window [" in ln and "WindowGroupLimit" not in ln]
    assert windows and all("_hk_b" in ln for ln in windows)
