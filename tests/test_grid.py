"""Grids, resampling, gap islands and interpolation."""
import datetime as dt

from horizonkit.operators import grid as G

T0 = dt.datetime(2020, 1, 1)
MIN_SCHEMA = "series_id string, ts timestamp_ntz, y double"


def minute_rows(values, series="s"):
    return [(series, T0 + dt.timedelta(minutes=i), v) for i, v in enumerate(values)]


def test_grid_inserts_missing_steps(make_series):
    df = make_series([("s", T0, 1.0), ("s", T0 + dt.timedelta(hours=3), 4.0)])
    out = G.to_grid(df, step="hour").orderBy("ts").collect()
    assert [r["y"] for r in out] == [1.0, None, None, 4.0]


def test_resample_mean_sum_and_empty_bin(make_series):
    rows = [("s", T0 + dt.timedelta(minutes=i), 2.0) for i in range(60)]
    rows += [("s", T0 + dt.timedelta(hours=2, minutes=i), 1.0) for i in range(60)]
    df = make_series(rows).withColumnRenamed("y", "m")
    df = df.withColumn("t", df["m"])
    out = G.resample(df, step="hour", mean_cols=["m"], sum_cols=["t"]).orderBy("ts").collect()
    assert [(r["m"], r["t"]) for r in out] == [(2.0, 120.0), (None, None), (1.0, 60.0)]


def test_gap_islands_reference_frame(make_series):
    vals = [1.0, 2.0, None, None, 5.0, 6.0, 7.0, None, 9.0, 10.0]
    gaps = G.find_gaps(make_series(minute_rows(vals)), ["y"], step="minute").orderBy("start").collect()
    assert [(g["rows"], g["duration_seconds"]) for g in gaps] == [(2, 120), (1, 60)]


def test_short_gap_interpolation(make_series):
    vals = [1.0, 2.0, None, None, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]
    out = G.interpolate_time(make_series(minute_rows(vals)), ["y"], step="minute").orderBy("ts").collect()
    assert [r["y"] for r in out][2:4] == [3.0, 4.0]


def test_long_gap_partial_fill(make_series):
    vals = [1.0] + [None] * 210 + [2.0]
    out = [r["y"] for r in G.interpolate_time(make_series(minute_rows(vals)), ["y"], step="minute", limit=180)
           .orderBy("ts").collect()]
    assert all(v is not None for v in out[1:181])
    assert all(v is None for v in out[181:211])
    whole = [r["y"] for r in G.interpolate_time(make_series(minute_rows(vals)), ["y"], step="minute", limit=180,
                                                 whole_gap_only=True).orderBy("ts").collect()]
    assert all(v is None for v in whole[1:211])


def test_edge_gaps_stay_missing(make_series):
    vals = [None, None, 3.0, 4.0, None]
    out = [r["y"] for r in G.interpolate_time(make_series(minute_rows(vals)), ["y"], step="minute")
           .orderBy("ts").collect()]
    assert out == [None, None, 3.0, 4.0, None]


def test_positional_interpolation_extends_edges(make_series):
    vals = [None, 2.0, None, None, 8.0, None]
    out = [r["y"] for r in G.interpolate_position(make_series(minute_rows(vals)), ["y"], step="minute")
           .orderBy("ts").collect()]
    assert out == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0]


def test_align_missing_is_null(make_series, spark):
    df = make_series(minute_rows([1.0, 2.0]))
    want = spark.createDataFrame([("s", T0), ("s", T0 + dt.timedelta(minutes=5))], "series_id string, ts timestamp_ntz")
    out = G.align(df, want).orderBy("ts").collect()
    assert [r["y"] for r in out] == [1.0, None]
