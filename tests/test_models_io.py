"""Model contracts, sources/sinks and the driver entry points (P*, I*, S*)."""
import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from horizonkit.operators import backtest as B
from horizonkit.operators import features as FE
from horizonkit.operators import grid as G
from horizonkit.operators import inference as I
from horizonkit.operators import models as MD
from horizonkit.operators import trend as TR
from horizonkit.session import scratch_path
from horizonkit.sources import store as S
from tests.conftest import hourly_rows

T0 = dt.datetime(2020, 1, 1)


def test_ar_recursion_matches_numpy(spark):
    coef = [0.5, 0.3, -0.2]            # intercept, lag 1, lag 2 on differences
    hist = [1.0, 2.0, 4.0, 5.0]
    df = spark.createDataFrame([(hist, coef)], "h array<double>, c array<double>")
    got = df.select(MD.ar_forecast_expr(F.col("h"), F.col("c"), [1, 2], 5, d=1).alias("f")).first()["f"]
    z = list(np.diff(hist))
    for _ in range(5):
        z.append(coef[0] + coef[1] * z[-1] + coef[2] * z[-2])
    exp = hist[-1] + np.cumsum(z[-5:])
    assert np.allclose(got, exp)


def test_fit_ar_recovers_coefficients(spark):
    rng = np.random.default_rng(0)
    z = [0.0, 0.0]
    for _ in range(3000):
        z.append(0.2 + 0.6 * z[-1] - 0.3 * z[-2] + rng.normal(scale=0.1))
    y = np.cumsum(z)
    df = spark.createDataFrame([("s", T0 + dt.timedelta(hours=i), float(v)) for i, v in enumerate(y)],
                               "series_id string, ts timestamp_ntz, y double")
    fit = MD.fit_ar(df, p=2, P=0, m=24).first()
    assert np.allclose(fit["coef"], [0.2, 0.6, -0.3], atol=0.05)


def test_seasonal_ar_lag_layout():
    assert MD.ar_lags(3, 2, 24) == [1, 2, 3, 24, 25, 26, 27, 48, 49, 50, 51]


def test_trend_season_fits_seasonal_series(spark):
    rng = np.random.default_rng(42)
    rows = [("s", T0 + dt.timedelta(hours=i), float(1.5 + np.sin(2 * np.pi * ((i % 24) - 6) / 24) + rng.normal(0, 0.05)))
            for i in range(720)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    fit, design = TR.fit_trend(df)
    fc = TR.forecast_trend(fit, design, df)
    mae = fc.join(df, ["series_id", "ts"]).agg(F.avg(F.abs(F.col("y") - F.col("forecast")))).first()[0]
    assert mae < 0.1


def test_direct_models_deterministic_and_bundle_roundtrip(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [("s", T0 + dt.timedelta(hours=i), float(1.5 + np.sin(i / 3.8) + rng.normal(0, 0.05)))
            for i in range(480)]
    g = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    f = FE.build_features(g, "y")
    sup = FE.supervised(f, [1, 24])
    cols = ["y_lag_1", "y_lag_24", "hour_sin", "hour_cos", "target_hour_sin", "target_hour_cos", "season"]
    train = FE.train_mask(sup, "2020-01-16 00:00:00", [c for c in cols if c != "season"])
    params = {"maxIter": 3, "maxDepth": 3, "seed": 7}
    m1 = MD.fit_direct(train, [1, 24], cols, "gbt", params)
    m2 = MD.fit_direct(train, [1, 24], cols, "gbt", params)
    origins = spark.createDataFrame([("s", T0 + dt.timedelta(hours=400))], "series_id string, origin timestamp_ntz")
    a, rej = I.score_origins(m1, f, origins, [1, 24], cols)
    b, _ = I.score_origins(m2, f, origins, [1, 24], cols)
    fa = sorted((r["horizon_step"], r["forecast"]) for r in a.collect())
    assert fa == sorted((r["horizon_step"], r["forecast"]) for r in b.collect()) and len(fa) == 2
    assert rej.count() == 0
    path = str(tmp_path / "bundle")
    S.save_bundle(m1, path, spark, {"feature_cols": cols})
    loaded, meta = S.load_bundle(spark, path)
    c, _ = I.score_origins(loaded, f, origins, [1, 24], cols)
    assert sorted((r["horizon_step"], r["forecast"]) for r in c.collect()) == fa
    # one input row with a single category value predicts the same (indexer lives in the pipeline)
    one = f.join(origins.withColumnRenamed("origin", "ts"), ["series_id", "ts"])
    d, _ = I.score_origins(loaded, one, origins, [1, 24], cols)
    assert sorted((r["horizon_step"], r["forecast"]) for r in d.collect()) == fa


def test_bounded_features_equal_full_history(spark):
    rows = hourly_rows(600, value=lambda i: float((i * 7) % 13))
    g = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    as_of = spark.createDataFrame([("s", T0 + dt.timedelta(hours=500))], "series_id string, as_of timestamp_ntz")
    rows_b, rej = I.features_at(I.read_window(g, as_of, 192), as_of, ["y_lag_168", "y_roll_std_168"])
    full = FE.build_features(g).where(F.col("ts") == T0 + dt.timedelta(hours=500)).first()
    b = rows_b.first()
    for c in ["y_lag_1", "y_lag_168", "y_roll_mean_168", "y_roll_std_168", "y_diff_24", "y_pct_change_24"]:
        assert b[c] == full[c] or abs(b[c] - full[c]) < 1e-9
    assert rej.count() == 0
    short = spark.createDataFrame([("s", T0 + dt.timedelta(hours=100))], "series_id string, as_of timestamp_ntz")
    _, rej2 = I.features_at(I.read_window(g, short, 192), short, ["y_lag_168"])
    assert [r["reason"] for r in rej2.collect()] == ["null_feature"]


def test_read_delimited_coerces(spark, tmp_path):
    p = tmp_path / "raw"
    p.mkdir()
    (p / "part.txt").write_text(
        "Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;Sub_metering_1;"
        "Sub_metering_2;Sub_metering_3\n"
        "16/12/2006;17:24:00;4.216;0.418;234.840;18.400;0.000;1.000;17.000\n"
        "1/1/2007;0:01:00;?;?;?;?;?;?;?\n"
        "2/1/2007;00:02:00;bad;0.1;240;1;;2;3\n")
    df = S.read_delimited(spark, str(p)).orderBy("datetime").collect()
    assert df[0]["datetime"] == dt.datetime(2006, 12, 16, 17, 24) and df[0]["global_active_power"] == 4.216
    assert df[1]["datetime"] == dt.datetime(2007, 1, 1, 0, 1) and df[1]["voltage"] is None
    assert df[2]["global_active_power"] is None and df[2]["sub_metering_1"] is None and df[2]["voltage"] == 240.0


def test_results_store_idempotent_and_registry(spark):
    root = scratch_path(spark, "t-results")
    df = spark.createDataFrame([("s", T0, 1, "m", 1.0, 2.0)],
                               "series_id string, origin timestamp_ntz, horizon_step int, method string, "
                               "actual double, forecast double")
    S.save_results(df, root, "a")
    S.save_results(df, root, "a")
    S.save_results(df, root, "b")
    allr = S.load_results(spark, root)
    assert allr.count() == 2 and {r["result_set"] for r in allr.collect()} == {"a", "b"}
    reg = scratch_path(spark, "t-registry")
    assert S.register_version(spark, reg, "m", "/x", "champion") == 1
    assert S.register_version(spark, reg, "m", "/y", "champion") == 2
    assert S.resolve_alias(spark, reg, "m", "champion").first()["version"] == 2


def test_validation_reports_all_rules(spark):
    from horizonkit.operators import quality as V
    df = spark.createDataFrame([(None, -1.0, 400.0), (T0, 1.0, 230.0)], "datetime timestamp_ntz, p double, v double")
    rules = [V.Rule("dt", "datetime", "not_null"), V.Rule("p", "p", "ge", lo=0.0),
             V.Rule("v", "v", "between", lo=150.0, hi=280.0)]
    s = {r["rule_id"]: r["n_failed"] for r in V.validate(df, rules).collect()}
    assert s == {"dt": 1, "p": 1, "v": 1}
    coerced = V.coerce(spark.createDataFrame([("1.5",), ("x",)], "p string"), {"p": "double"}).collect()
    assert [r["p"] for r in coerced] == [1.5, None]


def test_entry_and_registry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "MAE" in df.columns
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 90


def test_window_scan_pushes_range_to_parquet(spark, tmp_path):
    rows = hourly_rows(300)
    path = str(tmp_path / "hourly")
    spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double").write.parquet(path)
    w = I.read_window(spark.read.parquet(path), "2020-01-10 00:00:00", 24)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    assert w.count() == 25


def test_window_linear_learns_periodic_series(spark):
    rows = [("s", T0 + dt.timedelta(hours=i), float(np.sin(2 * np.pi * i / 24) + 0.5 * np.cos(2 * np.pi * i / 12)))
            for i in range(600)]
    g = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    win = FE.windows(g, 24, 6, ["y"], "y")
    fit = MD.fit_window_linear(win, 24, 6, ridge=1e-6)
    pred = MD.predict_window_linear(fit, win)
    truth = win.select("series_id", "origin", F.posexplode("y_window").alias("i", "actual")) \
               .withColumn("horizon_step", F.col("i") + 1)
    mae = pred.join(truth, ["series_id", "origin", "horizon_step"]) \
              .agg(F.avg(F.abs(F.col("_z") - F.col("actual")))).first()[0]
    assert mae < 1e-3


def test_pooled_direct_model_and_ar_backtest(spark):
    rng = np.random.default_rng(1)
    rows = [("s", T0 + dt.timedelta(hours=i), float(2 + np.sin(2 * np.pi * i / 24) + rng.normal(0, 0.05)))
            for i in range(400)]
    g = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    f = FE.build_features(g)
    sup = FE.supervised(f, [1, 6])
    cols = ["y_lag_1", "y_lag_24", "target_hour_sin", "target_hour_cos"]
    train = FE.train_mask(sup, "2020-01-15 00:00:00", cols)
    m = MD.fit_direct(train, [1, 6], cols, "linear", pooled=True)
    origins = spark.createDataFrame([("s", T0 + dt.timedelta(hours=380))], "series_id string, origin timestamp_ntz")
    fc, _ = I.score_origins(m, f, origins, [1, 6], cols, method="pooled_linear")
    assert sorted(r["horizon_step"] for r in fc.collect()) == [1, 6]
    # seasonal AR on the same series beats the flat forecast at the 24 h horizon
    fit = MD.fit_ar(g, p=1, P=1, m=24)
    lags = MD.ar_lags(1, 1, 24)
    o2 = spark.createDataFrame([("s", T0 + dt.timedelta(hours=h)) for h in (300, 330, 360)],
                               "series_id string, origin timestamp_ntz")
    ar = B.attach_actuals(MD.ar_backtest(g, fit, o2, 24, lags), g)
    nv = B.run_backtest(g, o2, [B.naive()], 24)
    mae = lambda d: d.agg(F.avg(F.abs(F.col("actual") - F.col("forecast")))).first()[0]
    assert ar.count() == 72 and mae(ar) < mae(nv)


def test_raw_reader_maps_nan_to_null(spark, tmp_path):
    p = tmp_path / "rawnan"
    p.mkdir()
    (p / "a.txt").write_text("Date;Time;v\n1/1/2007;0:00:00;nan\n1/1/2007;0:01:00;2.5\n")
    df = S.read_delimited(spark, str(p), ["Date", "Time", "v"], rename={}).orderBy("datetime").collect()
    assert df[0]["v"] is None and df[1]["v"] == 2.5


def test_run_log_appends_and_versions_mark_latest(spark):
    log = scratch_path(spark, "t-runlog")
    S.log_run(spark, log, "r1", {"horizon": 24}, {"mae": 0.5})
    S.log_run(spark, log, "r2", {"horizon": 168}, {"mae": 0.7})
    rows = spark.read.parquet(log).collect()
    assert {(r["run"], r["kind"], r["key"]) for r in rows} == {("r1", "param", "horizon"), ("r1", "metric", "mae"),
                                                              ("r2", "param", "horizon"), ("r2", "metric", "mae")}
    reg = scratch_path(spark, "t-reg2")
    S.register_version(spark, reg, "m", "/a")
    S.register_version(spark, reg, "m", "/b")
    latest = [r for r in S.versions(spark, reg).collect() if r["is_latest"]]
    assert [(r["version"], r["path"]) for r in latest] == [(2, "/b")]


def test_batch_forecast_has_24_steps_an_origin(spark, monkeypatch):
    from horizonkit.plans import q_models as Q
    monkeypatch.setattr(Q, "GBT_PARAMS", {"maxIter": 1, "maxDepth": 1, "seed": 42})
    rows = Q.i4_batch_forecast(spark, "/root/testdata/sf0.01").collect()
    steps = {}
    for r in rows:
        steps.setdefault((r["series_id"], r["origin"]), []).append(r["horizon_step"])
    assert steps and all(sorted(x) == list(range(1, 25)) for x in steps.values())


def test_recent_window_reads_its_days_only(spark, tmp_path):
    """The store's scan has partition filters and opens the days of the window; null features raise."""
    from horizonkit.sources.store import read_recent, write_series_store
    rows = [("a", T0 + dt.timedelta(hours=i), float(np.sin(i / 5.0) + 2), 1) for i in range(24 * 60) if i % 97]
    rows += [("b", T0 + dt.timedelta(hours=i), float(i % 7 + 1), 1) for i in range(24 * 30)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double, n_events int")
    root = str(tmp_path / "store")
    write_series_store(df, root)
    near, as_of = read_recent(spark, root, 192)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day#" in plan
    got = {(r.series_id, r.ts) for r in near.collect()}
    last = {"a": max(t for s, t, *_ in rows if s == "a"), "b": max(t for s, t, *_ in rows if s == "b")}
    assert got == {(s, t) for s, t, *_ in rows if last[s] - dt.timedelta(hours=192) <= t <= last[s]}
    import shutil
    for k in (*range(10, 20), *range(33, 45)):  # days outside both windows: not opened
        shutil.move(f"{root}/rows/day={(T0 + dt.timedelta(days=k)).date()}", f"{tmp_path}/away{k}")
    near, as_of = read_recent(spark, root, 192)
    recent = I.on_grid(near, as_of)
    assert recent.count() == 2 * 193
    f, rejects = I.features_at(recent, as_of, ["y_lag_168", "y_lag_1"])
    full = FE.build_features(G.to_grid(df, step="hour"), "y")
    want = {r.series_id: r for r in full.join(as_of.withColumnRenamed("as_of", "ts"), ["series_id", "ts"]).collect()}
    for r in f.collect():
        assert r.y_lag_168 == want[r.series_id].y_lag_168 and r.y_roll_mean_24 == want[r.series_id].y_roll_mean_24
    hole = spark.createDataFrame([("a", T0 + dt.timedelta(hours=97 * 10 + 1))], "series_id string, as_of timestamp_ntz")
    near, _ = read_recent(spark, root, 192, hole)
    _, rejects = I.features_at(I.on_grid(near, hole), hole, ["y_lag_1"])
    assert [r.reason for r in rejects.collect()] == ["null_feature"]
    strict, _ = I.features_at(I.on_grid(near, hole), hole, ["y_lag_1"], strict=True)
    with pytest.raises(Exception, match="missing values"):
        strict.collect()
    nothing, _ = read_recent(spark, root, 192, as_of.limit(0))
    assert nothing.collect() == []


def test_a_fit_reads_cached_rows_in_few_partitions(spark, monkeypatch):
    class Seen:
        def fit(self, rows):
            return rows.rdd.getNumPartitions(), rows.is_cached, rows.columns, rows.count()

    monkeypatch.setattr(MD, "direct_pipeline", lambda *a: Seen())
    monkeypatch.setattr(MD, "FIT_ROWS", 100)
    train = spark.range(500, numPartitions=40).selectExpr("id % 2 + 1 AS horizon", "id * 0.5 AS x", "id AS other", "id * 1.0 AS y_target")
    assert MD.fit_direct(train, [1, 2], ["x"]) == {h: (3, True, ["x", "y_target"], 250) for h in (1, 2)}
    assert MD.fit_direct(train, [1, 2], ["x"], pooled=True) == {"pooled": (5, True, ["x", "horizon", "y_target"], 500)}


def test_origins_are_scored_from_rows_read_once(spark):
    f = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, h), 1.0 if h else None) for h in range(3)], "series_id string, ts timestamp_ntz, x double")
    origins = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, h)) for h in (0, 1, 5)], "series_id string, origin timestamp_ntz")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    class Model:
        def transform(self, rows):
            return rows.withColumn("prediction", F.col("x") + F.col("horizon"))

    fc, rejects = I.score_origins({h: Model() for h in (1, 2, 3)}, f.mapInArrow(counted, f.schema), origins, [1, 2, 3], ["x"])
    assert sorted((r.horizon_step, r.forecast) for r in fc.collect()) == [(1, 2.0), (2, 3.0), (3, 4.0)]
    assert sorted(r.reason for r in rejects.collect()) == ["missing_origin", "null_feature"]
    assert reads.value == 3
