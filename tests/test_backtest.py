"""Splits, origins, lookup baselines and the rolling-origin harness (B1–B14, M*)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from horizonkit.operators import backtest as B
from horizonkit.operators import metrics as M
from tests.conftest import hourly_rows

T0 = dt.datetime(2020, 1, 1)


def t(h):
    return T0 + dt.timedelta(hours=h)


@pytest.fixture
def long_series(make_series):
    return make_series(hourly_rows(240))  # 10 days, value = position


def test_split_point_floors_to_midnight(long_series, spark):
    sp = B.split_point(long_series, 0.2).first()
    assert sp["test_start"] == dt.datetime(2020, 1, 9)   # row 192 → day 9 00:00


def test_origins_inclusive_end(long_series):
    o = B.forecast_origins(B.split_point(long_series, 0.2), 24, 24).orderBy("origin").collect()
    assert [r["origin"] for r in o] == [dt.datetime(2020, 1, 9)]  # last valid = max - 24h = Jan 9 23:00


def origins_df(spark, hours):
    return spark.createDataFrame([("s", t(h)) for h in hours], "series_id string, origin timestamp_ntz")


def test_naive_and_seasonal_values(long_series, spark):
    bt = B.run_backtest(long_series, origins_df(spark, [200]), [B.naive(), B.daily_seasonal_naive(),
                                                                 B.weekly_seasonal_naive()], 24)
    d = {(r["method"], r["horizon_step"]): r for r in bt.collect()}
    assert d[("naive", 5)]["forecast"] == 200.0
    assert d[("daily_naive", 5)]["forecast"] == 181.0
    assert d[("weekly_naive", 5)]["forecast"] == 37.0
    assert d[("naive", 5)]["actual"] == 205.0


def test_guard_horizon_beyond_lag(long_series, spark):
    with pytest.raises(ValueError):
        B.run_backtest(long_series, origins_df(spark, [200]), [B.daily_seasonal_naive()], 25)


def test_whole_origin_skipped_when_lookback_leaves_series(long_series, spark):
    bt = B.run_backtest(long_series, origins_df(spark, [100, 200]), [B.weekly_seasonal_naive()], 24)
    assert {r["origin"] for r in bt.collect()} == {t(200)}
    assert bt.count() == 24


def test_tiled_profile_equals_daily_naive_up_to_24(long_series, spark):
    bt = B.run_backtest(long_series, origins_df(spark, [100, 150, 190]), [B.daily_seasonal_naive(),
                                                                           B.tiled_profile(24)], 24)
    p = bt.groupBy("origin", "horizon_step").agg(F.countDistinct("forecast").alias("k")).collect()
    assert all(r["k"] == 1 for r in p)


def test_tiled_profile_at_long_horizon(make_series, spark):
    g = make_series(hourly_rows(400))
    bt = B.run_backtest(g, origins_df(spark, [200]), [B.tiled_profile(24), B.weekly_seasonal_naive(), B.naive()], 168)
    d = {(r["method"], r["horizon_step"]): r["forecast"] for r in bt.collect()}
    assert d[("daily_profile", 25)] == d[("daily_profile", 1)] == 177.0
    # final step of a 168 horizon: flat, weekly and tiled all read the origin value
    assert d[("naive", 168)] == d[("weekly_naive", 168)] == d[("daily_profile", 168)] == 200.0


def test_actual_null_beyond_end_rows_kept(make_series, spark):
    g = make_series(hourly_rows(100))
    fc = spark.createDataFrame([("s", t(90), 20, "m", 1.0)],
                               "series_id string, origin timestamp_ntz, horizon_step int, method string, forecast double")
    r = B.attach_actuals(fc, g).first()
    assert r["actual"] is None


def test_from_continuous(make_series, spark):
    g = make_series(hourly_rows(50))
    fc = g.select("series_id", "ts", (F.col("y") * 10).alias("forecast"))
    bt = B.from_continuous(fc, g, origins_df(spark, [40]), 24, "cont").orderBy("horizon_step").collect()
    assert len(bt) == 24 and bt[0]["forecast"] == 410.0 and bt[0]["actual"] == 41.0
    assert bt[-1]["forecast"] is None and bt[-1]["actual"] is None


def test_metrics_masks(spark):
    rows = [("m", 0.0, 1.0), ("m", 2.0, 1.0), ("m", None, 1.0), ("m", 0.0, 0.0)]
    bt = spark.createDataFrame(rows, "method string, actual double, forecast double")
    r = M.score(bt).first()
    assert r["n"] == 3
    assert abs(r["MAE"] - 2 / 3) < 1e-12
    assert abs(r["RMSE"] - (2 / 3) ** 0.5) < 1e-12
    assert abs(r["MAPE"] - 50.0) < 1e-12                 # only the actual=2 row
    assert abs(r["sMAPE"] - (200.0 + 2 / 3 * 100) / 2) < 1e-9  # both-zero row excluded


def test_leaderboard_rank(long_series, spark):
    bt = B.run_backtest(long_series, origins_df(spark, [200]), [B.naive(), B.daily_seasonal_naive()], 24)
    lb = {r["method"]: r for r in M.leaderboard(bt).collect()}
    assert lb["naive"]["mae_rank"] == 1 and lb["naive"]["MAE"] == 12.5
    assert lb["daily_naive"]["MAE"] == 24.0 and lb["daily_naive"]["mae_rank"] == 2
