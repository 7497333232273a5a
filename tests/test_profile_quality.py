"""Profiles, quality reports and horizon tables on hand-computable inputs."""
import datetime as dt

import numpy as np

from horizonkit.operators import metrics as M
from horizonkit.operators import profile as P
from horizonkit.operators import quality as V

T0 = dt.datetime(2020, 1, 1)


def test_box_stats_whiskers_and_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 100.0]
    df = spark.createDataFrame([("s", "g", v) for v in vals], "series_id string, k string, y double")
    r = P.box_stats(df, "k", keys=["series_id"]).first()
    q1, q3 = np.percentile(vals, 25), np.percentile(vals, 75)
    assert (r["q1"], r["median"], r["q3"]) == (q1, np.percentile(vals, 50), q3)
    assert r["whisker_hi"] == 9.0 and r["whisker_lo"] == 1.0 and r["n_outliers"] == 1 and r["n"] == 10


def test_holiday_effect_splits_days(spark):
    days = [T0 + dt.timedelta(days=i) for i in range(10)]          # Jan 1 is a holiday
    df = spark.createDataFrame([("s", d, 10.0 if i == 0 else float(i)) for i, d in enumerate(days)],
                               "series_id string, ts timestamp_ntz, y double")
    cal = P.holiday_calendar(P.years_of(df))
    out = {r["is_holiday"]: r for r in P.holiday_effect(df, cal, keys=["series_id"]).collect()}
    assert out[True]["n"] == 1 and out[True]["mean"] == 10.0
    assert out[False]["n"] == 9 and out[False]["median"] == 5.0


def test_missing_duplicates_and_dropna(spark):
    df = spark.createDataFrame([("s", T0, 1.0, None), ("s", T0, None, 2.0), ("s", T0 + dt.timedelta(hours=1), 3.0, 4.0),
                                ("s", T0 + dt.timedelta(hours=2), 5.0, 6.0)],
                               "series_id string, ts timestamp_ntz, a double, b double")
    mp = {r["column"]: r["missing_pct"] for r in V.missing_pct(df, ["a", "b"]).collect()}
    assert mp == {"a": 25.0, "b": 25.0}
    assert V.duplicate_ts(df).first()["duplicate_ts"] == 1
    r = V.drop_null_report(df, ["series_id"], ["a", "b"]).first()
    assert (r["rows_before"], r["rows_after"], r["rows_lost"], r["lost_pct"]) == (4, 2, 2, 50.0)


def test_horizon_tables(spark):
    rows = [("m", h, 1.0 + h, 1.0) for h in (1, 24, 168)] + [("m", 5, 1.0, 1.0)]
    bt = spark.createDataFrame(rows, "method string, horizon_step int, actual double, forecast double")
    ex = M.horizon_exact(bt).first()
    assert (ex["mae_h1"], ex["mae_h24"], ex["mae_h168"]) == (1.0, 24.0, 168.0)
    short = spark.createDataFrame([("m", 1, 2.0, 1.0), ("m", 2, 4.0, 1.0)],
                                  "method string, horizon_step int, actual double, forecast double")
    av = M.horizon_avg(short, bt).first()
    assert (av["mae_1h"], av["mae_24h"], av["mae_7d"]) == (1.0, 2.0, 193.0 / 4)


def test_agreement_tolerance(spark):
    a = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "actual double, forecast double")
    b = spark.createDataFrame([(1.0, 2.01), (1.0, 0.0)], "actual double, forecast double")
    r = M.agreement(a, b).first()
    assert r["agrees"] and r["n_a"] == r["n_b"] == 2
