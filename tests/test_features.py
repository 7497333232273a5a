"""Feature contracts: positional lags, exclusive full windows, no leakage."""
import datetime as dt

from pyspark.sql import functions as F

from horizonkit.operators import features as FE
from tests.conftest import hourly_rows


def by_ts(df):
    return {r["ts"]: r for r in df.collect()}


def test_lags_are_positional(make_series):
    out = by_ts(FE.lags(make_series(hourly_rows(300)), ks=[1, 24, 168]))
    r = out[dt.datetime(2020, 1, 1) + dt.timedelta(hours=200)]
    assert (r["y_lag_1"], r["y_lag_24"], r["y_lag_168"]) == (199.0, 176.0, 32.0)


def test_rolling_excludes_current_and_needs_full_window(make_series):
    rows = hourly_rows(100)
    rows[50] = (rows[50][0], rows[50][1], None)
    out = by_ts(FE.rolling(make_series(rows), ns=[24]))
    t = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(hours=i)
    assert out[t(23)]["y_roll_mean_24"] is None
    assert out[t(24)]["y_roll_mean_24"] == sum(range(24)) / 24
    assert out[t(24)]["y_roll_max_24"] == 23.0
    assert out[t(60)]["y_roll_mean_24"] is None        # window holds the missing row 50
    assert out[t(75)]["y_roll_mean_24"] == sum(range(51, 75)) / 24


def test_momentum_never_uses_current_row(make_series, spark):
    rows = hourly_rows(60, value=lambda i: float(i + 1))
    a = by_ts(FE.momentum(make_series(rows)))
    rows2 = list(rows)
    rows2[40] = (rows[40][0], rows[40][1], 999.0)
    b = by_ts(FE.momentum(make_series(rows2)))
    ts40 = rows[40][1]
    for c in ["y_diff_1", "y_diff_24", "y_pct_change_1", "y_pct_change_24"]:
        assert a[ts40][c] == b[ts40][c]
    assert a[ts40]["y_diff_1"] == 1.0 and a[ts40]["y_diff_24"] == 24.0


def test_pct_change_zero_denominator(make_series):
    rows = hourly_rows(30, value=lambda i: 0.0 if i < 29 else 5.0)
    out = by_ts(FE.momentum(make_series(rows)))
    assert out[rows[29][1]]["y_pct_change_1"] is None


def test_calendar_features(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 6, 3),), (dt.datetime(2020, 1, 11, 15),),
                                (dt.datetime(2020, 7, 4, 12),)], "ts timestamp_ntz")
    out = FE.cyclical(FE.calendar(df)).orderBy("ts").collect()
    assert [(r["hour"], r["dayofweek"], r["is_weekend"], r["season"], r["quarter"]) for r in out] == \
        [(3, 0, 0, "winter", 1), (15, 5, 1, "winter", 1), (12, 5, 1, "summer", 3)]
    assert abs(out[0]["hour_sin"] - 0.7071067811865476) < 1e-12


def test_day_flag(make_series, spark):
    rows = hourly_rows(48)
    days = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "day timestamp_ntz")
    out = FE.day_flag(make_series(rows), days).collect()
    assert sum(r["is_flagged_anomaly"] for r in out) == 24


def test_supervised_label_and_target_calendar(make_series):
    s = FE.supervised(make_series(hourly_rows(48)), [1, 24])
    r = [x for x in s.collect() if x["ts"] == dt.datetime(2020, 1, 1, 0)]
    d = {x["horizon"]: x for x in r}
    assert d[1]["y_target"] == 1.0 and d[24]["y_target"] == 24.0
    assert abs(d[24]["target_hour_sin"]) < 1e-12      # target hour 0


def test_train_mask_has_no_future_target(make_series):
    s = FE.supervised(make_series(hourly_rows(100)), [1, 24])
    m = FE.train_mask(s, "2020-01-03 00:00:00", [])
    mx = m.groupBy("horizon").agg(F.max("ts").alias("mx")).collect()
    for r in mx:
        assert r["mx"] + dt.timedelta(hours=r["horizon"]) <= dt.datetime(2020, 1, 3)


def test_windows_drop_nulls_and_cover_range(make_series):
    rows = hourly_rows(200, value=lambda i: float(i))
    rows[60] = (rows[60][0], rows[60][1], None)
    w = FE.windows(make_series(rows), 48, 24, ["y"], "y", bucket_steps=64).collect()
    origins = {r["origin"] for r in w}
    t = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(hours=i)
    expected = {t(i) for i in range(47, 200 - 24) if not (i - 47 <= 60 <= i + 24)}
    assert origins == expected
    r = [x for x in w if x["origin"] == t(108)][0]
    assert r["x_window"][0] == [61.0] and r["y_window"] == [float(i) for i in range(109, 133)]


def test_standardize_population_std(spark):
    df = spark.createDataFrame([("s", 1.0), ("s", 3.0)], "series_id string, a double")
    out = sorted(r["a"] for r in FE.standardize(df, ["a"]).collect())
    assert out == [-1.0, 1.0]


def test_model_columns_by_exclusion(make_series):
    f = FE.build_features(make_series(hourly_rows(5)))
    cols = FE.model_columns(f)
    assert not {"series_id", "ts", "y", "hour", "dayofweek", "month", "season"} & set(cols)
    assert {"hour_sin", "y_lag_168", "y_roll_std_24", "is_weekend", "is_flagged_anomaly"} <= set(cols)
    assert FE.model_columns(f, exclude=(*FE.FEATURE_EXCLUDE, "quarter")) == [c for c in cols if c != "quarter"]
