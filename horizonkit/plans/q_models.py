"""Model, model-backtest and batch-inference queries (P*, B10–B13, I*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import all_not_null
from ..functions.timecols import add_steps
from ..operators import arma as AR
from ..operators import attribution as AT
from ..operators import backtest as B
from ..operators import features as FE
from ..operators import inference as I
from ..operators import information as IN
from ..operators import models as MD
from ..operators import trend as TR
from ..operators import tuning as TU
from ..sources import tables as T
from . import oracle as O
from .q_core import hourly_backtest
from .q_features import FEATURES_SQL, features
from ..session import materialize, scratch_path
from ..sources.store import load_bundle, save_bundle
from .registry import out, register

R = O.R
HORIZONS = tuple(range(1, 25))
GBT_PARAMS = {"seed": 42}  # otherwise the library's own
MODEL_FEATURES = ["hour_sin", "hour_cos", "dayofweek_sin", "dayofweek_cos", "month_sin", "month_cos", "quarter",
                  "is_weekend", "is_flagged_anomaly", "y_lag_1", "y_lag_6", "y_lag_24", "y_lag_168",
                  "y_roll_mean_24", "y_roll_std_24", "y_roll_min_24", "y_roll_max_24", "y_roll_mean_168",
                  "y_roll_std_168", "y_diff_1", "y_diff_24", "n_events",
                  "target_hour_sin", "target_hour_cos", "target_dayofweek_sin", "target_dayofweek_cos",
                  "target_month_sin", "target_month_cos", "target_is_weekend"]


def _split(spark, sf_dir, frac=0.2):
    """Model input: the refreshed hourly grid (minute data interpolated first),
    checkpointed once — split, features and actuals all read it."""
    g = materialize(T.refreshed_hourly(spark, sf_dir))
    return g, B.split_point(g, frac)


def model_features(spark, sf_dir, g=None):
    from .q_features import flagged_days
    g = g if g is not None else T.refreshed_hourly(spark, sf_dir)
    return FE.build_features(g, "y", flagged_days(T.hourly_grid(spark, sf_dir)))


def _origins(split, horizon=24):
    return B.forecast_origins(split, horizon, 24)


# ---------------------------------------------------------------- P1, P2, B13
def _ar_fit(spark, sf_dir):
    g, split = _split(spark, sf_dir)
    train = g.join(split.select("series_id", "test_start"), "series_id").where(F.col("ts") < F.col("test_start"))
    return g, split, MD.fit_ar(train.select("series_id", "ts", "y"), 3, 2, 24)


@register("p1_seasonal_ar_fit")
def p1_seasonal_ar_fit(spark, sf_dir):
    return out(_ar_fit(spark, sf_dir)[2])


@register("b13_ar_backtest")
def b13_ar_backtest(spark, sf_dir):
    g, split, fit = _ar_fit(spark, sf_dir)
    fc = MD.ar_backtest(g, fit, _origins(split), 24, MD.ar_lags(3, 2, 24))
    return out(B.attach_actuals(fc, g))


def _arma_fit(spark, sf_dir):
    """The whole search, p, q up to 3 and P, Q up to 2, on the last 1,440 hours of training."""
    g, split = _split(spark, sf_dir)
    train = g.join(split.select("series_id", "test_start"), "series_id").where(
        (F.col("ts") < F.col("test_start")) & (F.col("ts") >= add_steps("test_start", -1440, "hour")))
    return g, split, AR.search_arma(train.select("series_id", "ts", "y"))


@register("p2_ar_order_search")
def p2_ar_order_search(spark, sf_dir):
    return out(_arma_fit(spark, sf_dir)[2])


@register("b13_arma_backtest")
def b13_arma_backtest(spark, sf_dir):
    g, split, fit = _arma_fit(spark, sf_dir)
    return out(B.attach_actuals(AR.arma_backtest(g, materialize(fit), _origins(split), 24), g))


# ---------------------------------------------------------------- P3, B10
@register("b10_trend_season_backtest")
def b10_trend_season_backtest(spark, sf_dir):
    """Trend and seasonal model fit once on the training span, one continuous
    forecast over the grid, sliced into origin/step rows."""
    g, split = _split(spark, sf_dir)
    train = g.join(split.select("series_id", "test_start"), "series_id").where(F.col("ts") < F.col("test_start"))
    fit, design = TR.fit_trend(train.select("series_id", "ts", "y"))
    fc = TR.forecast_trend(fit, design, g.select("series_id", "ts"))
    return out(B.from_continuous(fc, g, _origins(split), 24, "trend_season"))


@register("p3_components")
def p3_components(spark, sf_dir):
    g, split = _split(spark, sf_dir)
    train = g.join(split.select("series_id", "test_start"), "series_id").where(F.col("ts") < F.col("test_start"))
    fit, design = TR.fit_trend(train.select("series_id", "ts", "y"))
    return out(TR.forecast_trend(fit, design, g.select("series_id", "ts")))


@register("p3_changepoints")
def p3_changepoints(spark, sf_dir):
    """The changes of slope chosen in the daily order series."""
    fit, _ = TR.fit_trend(T.daily_grid(spark, sf_dir), seasons={k: TR.SEASONS[k] for k in ("yearly", "weekly")})
    return out(fit.select("series_id", "n", "sigma", F.inline_outer("changes")).withColumnRenamed("at", "at_seconds"))


# ---------------------------------------------------------------- P4, P7, B11, I*
def supervised_frame(spark, sf_dir):
    g, split = _split(spark, sf_dir)
    f = materialize(model_features(spark, sf_dir, g))  # read by the training frame and the scoring
    sup = FE.supervised(f, HORIZONS)
    return g, split, f, sup


def fit_models(spark, sf_dir):
    g, split, f, sup = supervised_frame(spark, sf_dir)
    train = FE.train_mask(sup.join(split.select("series_id", "test_start"), "series_id"), F.col("test_start"),
                          MODEL_FEATURES)
    return g, split, f, _bundle(spark, sf_dir, train)


_bundles: dict[tuple, str] = {}


def _bundle(spark, sf_dir, train):
    """The models of all horizons: fitted once for the same events in an application, and
    loaded from the stored bundle after that. The training frame is written by horizon,
    so each fit scans its own rows."""
    mark = T.read_table(spark, sf_dir, "events").agg(F.count(F.lit(1)), F.sum(F.xxhash64("event_type", "ts", "value").cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, sf_dir, *mark)
    if key not in _bundles:
        by = scratch_path(spark, "train-by-horizon")
        train.select(*MODEL_FEATURES, "y_target", "horizon").write.partitionBy("horizon").parquet(by)
        models = MD.fit_direct(spark.read.parquet(by), HORIZONS, MODEL_FEATURES, "gbt", GBT_PARAMS,
                               parallelism=max(8, spark.sparkContext.defaultParallelism))
        path = scratch_path(spark, "bundle")
        save_bundle(models, path, spark, {"features": MODEL_FEATURES})
        _bundles[key] = path
    return load_bundle(spark, _bundles[key])[0]


def _with_rejects(fc, rejects):
    """Forecast rows, and a row with the reason for each origin that has none."""
    return fc.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects.withColumn("method", F.lit("rejected")), allowMissingColumns=True)


@register("p4_direct_fit")
def p4_direct_fit(spark, sf_dir):
    """Training-set fit quality of the per-horizon boosted-tree models."""
    g, split, f, sup = supervised_frame(spark, sf_dir)
    train = FE.train_mask(sup.join(split.select("series_id", "test_start"), "series_id"), F.col("test_start"),
                          MODEL_FEATURES)
    train = materialize(train)
    fc = MD.predict_direct(_bundle(spark, sf_dir, train), train)
    sc = fc.join(train.select("series_id", F.col("ts").alias("origin"), F.col("horizon").alias("horizon_step"),
                              F.col("y_target").alias("actual")), ["series_id", "origin", "horizon_step"])
    return out(sc.groupBy("horizon_step").agg(F.avg(F.abs(F.col("actual") - F.col("forecast"))).alias("train_mae"),
                                              F.count(F.lit(1)).alias("n")))


@register("b11_direct_backtest")
def b11_direct_backtest(spark, sf_dir):
    g, split, f, models = fit_models(spark, sf_dir)
    fc, _ = I.score_origins(models, f, _origins(split), HORIZONS, MODEL_FEATURES)
    return out(B.attach_actuals(fc, g))


@register("p7_feature_importance")
def p7_feature_importance(spark, sf_dir):
    _, _, _, models = fit_models(spark, sf_dir)
    return MD.feature_importance(models, MODEL_FEATURES, spark, 20)


def _at_24(spark, sf_dir):
    """(model of step 24, test rows) on one horizon's frame only."""
    g, split = _split(spark, sf_dir)
    sup = FE.supervised(model_features(spark, sf_dir, g), [24]).join(split.select("series_id", "test_start"), "series_id")
    sup = materialize(sup)
    train = FE.train_mask(sup, F.col("test_start"), MODEL_FEATURES)
    models = MD.fit_direct(train, [24], MODEL_FEATURES, "gbt", GBT_PARAMS)
    return models, sup.where(F.col("ts") >= F.col("test_start")).where(all_not_null([*MODEL_FEATURES, "y_target"]))


@register("p8_permutation_importance")
def p8_permutation_importance(spark, sf_dir):
    """MAE increase at h=24 when one input column is permuted (test period rows), every column."""
    models, test = _at_24(spark, sf_dir)
    return MD.permutation_importance(models, test, MODEL_FEATURES, 24)


@register("p8_influence")
def p8_influence(spark, sf_dir):
    """Mean size of each feature's part in the predictions at h=24 (test period rows)."""
    models, test = _at_24(spark, sf_dir)
    assembler, model = models[24].stages[-2:]
    return out(AT.influence(AT.tree_contributions(model, assembler.transform(test), ["series_id", "ts"]), MODEL_FEATURES))


MI_COLS = ["y_lag_1", "y_lag_6", "y_lag_24", "y_lag_168", "y_diff_1", "n_events"]


def _mi_sql() -> str:
    parts = []
    for c in MI_COLS:
        parts.append(f"""SELECT '{c}' AS feature,
  CAST(coalesce(least(floor(({c} - lo_{c}) / nullif((hi_{c} - lo_{c}) / 10, 0)), 9), 0) AS INTEGER) AS bin_x,
  CAST(coalesce(least(floor((y - lo_y) / nullif((hi_y - lo_y) / 10, 0)), 9), 0) AS INTEGER) AS bin_y FROM d, r""")
    rng = ", ".join([f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in [*MI_COLS, "y"]])
    nn = " AND ".join(f"{c} IS NOT NULL" for c in [*MI_COLS, "y"])
    return f"""WITH {FEATURES_SQL},
d AS (SELECT * FROM feat WHERE {nn}),
r AS (SELECT {rng} FROM d),
j AS ({" UNION ALL ".join(parts)}),
jc AS (SELECT feature, bin_x, bin_y, count(*) AS nxy FROM j GROUP BY 1, 2, 3),
t AS (SELECT *, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, bin_x) AS nx,
        sum(nxy) OVER (PARTITION BY feature, bin_y) AS ny FROM jc),
mi AS (SELECT feature, sum((nxy * 1.0 / n) * ln((nxy * 1.0 * n) / (nx * ny))) AS mutual_info FROM t GROUP BY 1)"""


@register("p9_mutual_info", _mi_sql() + f" SELECT feature, round(mutual_info, {R}) AS mutual_info FROM mi")
def p9_mutual_info(spark, sf_dir):
    return out(MD.mutual_info(features(spark, sf_dir), MI_COLS, "y", 10))


@register("p9_knn_mutual_info")
def p9_knn_mutual_info(spark, sf_dir):
    """Every model input of the feature table (by exclusion), from nearest neighbours."""
    f = model_features(spark, sf_dir, T.hourly_grid(spark, sf_dir))
    return out(IN.knn_mutual_info(f, FE.model_columns(f), "y"))


@register("p10_rank_compare", _mi_sql() + f""",
c AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, y)) AS abs_corr FROM d" for c in MI_COLS)}),
ra AS (SELECT feature, mutual_info, rank() OVER (ORDER BY round(mutual_info, {R}) DESC)
         + (count(*) OVER (PARTITION BY round(mutual_info, {R})) - 1) / 2.0 AS rank_mutual_info FROM mi),
rb AS (SELECT feature, abs_corr, rank() OVER (ORDER BY round(abs_corr, {R}) DESC)
         + (count(*) OVER (PARTITION BY round(abs_corr, {R})) - 1) / 2.0 AS rank_abs_corr FROM c)
SELECT ra.feature, round(mutual_info, {R}) AS mutual_info, rank_mutual_info, round(abs_corr, {R}) AS abs_corr,
  rank_abs_corr FROM ra JOIN rb ON ra.feature = rb.feature""")
def p10_rank_compare(spark, sf_dir):
    f = features(spark, sf_dir)
    mi = out(MD.mutual_info(f, MI_COLS, "y", 10))
    d = f.where(all_not_null([*MI_COLS, "y"]))
    one = d.agg(*[F.abs(F.corr(c, "y")).alias(c) for c in MI_COLS])
    corr = out(one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("abs_corr"))
                                            for c in MI_COLS]))))
    return MD.compare_ranks(mi, corr, "mutual_info", "abs_corr")


# ---------------------------------------------------------------- P6, B12: window regression
@register("b12_window_backtest")
def b12_window_backtest(spark, sf_dir, lookback: int = 48, horizon: int = 24):
    """Direct sequence-to-horizon linear map on scaled look-back windows
    (method ``window_linear``): all steps from one moment pass."""
    g, split = _split(spark, sf_dir)
    train_rows = g.join(split, "series_id").where(F.col("ts") < F.col("test_start"))
    scaler = FE.fit_scaler(train_rows)
    win = FE.scale_windows(FE.windows(g, lookback, horizon, ["y"], "y"), scaler)
    win = materialize(win.join(split.select("series_id", "test_start"), "series_id"))
    train = win.where(F.col("origin") <= F.expr(f"test_start - make_dt_interval(0, {horizon}, 0, 0)"))
    fit = MD.fit_window_linear(train, lookback, horizon)
    test = win.join(_origins(split).select("series_id", "origin"), ["series_id", "origin"], "left_semi")
    fc = MD.predict_window_linear(fit, test)
    fc = fc.join(scaler, "series_id").select("series_id", "origin", "horizon_step", "method",
                                             (F.col("_z") * F.col("scale_std") + F.col("scale_mean")).alias("forecast"))
    return out(B.attach_actuals(fc, g))


# ---------------------------------------------------------------- I1–I11
@register("i1_features_at_latest", f"""WITH {FEATURES_SQL}
SELECT * FROM feat WHERE (series_id, ts) IN (SELECT series_id, max(ts) FROM hourly GROUP BY 1)""")
def i1_features_at_latest(spark, sf_dir):
    """Feature row at the latest timestamp from a bounded 192-step read; equals the full-history row."""
    g = T.hourly_grid(spark, sf_dir)
    from ..sources.store import latest_origin
    from .q_features import flagged_days
    as_of = latest_origin(g)
    recent = I.read_window(g, as_of, I.LOOKBACK)
    rows, _ = I.features_at(recent, as_of, [], flagged_days(g))
    return out(rows)


ORIGIN_FEATURES = [c for c in MODEL_FEATURES if not c.startswith("target_")]


@register("i2_latest_from_store", f"""WITH {FEATURES_SQL},
last_rows AS (SELECT * FROM feat WHERE (series_id, ts) IN (SELECT series_id, max(ts) FROM hourly GROUP BY 1))
SELECT series_id, ts, {", ".join(f"CASE WHEN {' AND '.join(f'{c} IS NOT NULL' for c in ORIGIN_FEATURES)} THEN {c} END AS {c}" for c in ORIGIN_FEATURES)},
  CASE WHEN NOT ({' AND '.join(f'{c} IS NOT NULL' for c in ORIGIN_FEATURES)}) THEN 'null_feature' END AS reason FROM last_rows""")
def i2_latest_from_store(spark, sf_dir):
    """Feature rows at each series' latest hour, from the day partitions of the last 192
    hours of the hourly store; rejected ones have a reason in place of features."""
    from ..sources.store import read_recent, write_series_store
    from .q_features import flagged_days
    root = scratch_path(spark, "hourly-store")
    write_series_store(T.hourly_grid(spark, sf_dir), root)
    near, as_of = read_recent(spark, root, I.LOOKBACK)
    recent = materialize(I.on_grid(near, as_of))
    rows, rejects = I.features_at(recent, as_of, ORIGIN_FEATURES, flagged_days(recent))
    rows = rows.select("series_id", "ts", *ORIGIN_FEATURES, F.lit(None).cast("string").alias("reason"))
    return out(rows.unionByName(rejects, allowMissingColumns=True))


@register("i3_predict_latest")
def i3_predict_latest(spark, sf_dir):
    g, split, f, models = fit_models(spark, sf_dir)
    from ..sources.store import latest_origin
    as_of = latest_origin(g).withColumnRenamed("as_of", "origin")
    return out(I.target_ts(_with_rejects(*I.score_origins(models, f, as_of, HORIZONS, MODEL_FEATURES))))


@register("i5_score_origins")
def i5_score_origins(spark, sf_dir):
    """Every daily origin of the test period scored in one pass; rejected
    origins are reported with forecast = null and the reason."""
    g, split, f, models = fit_models(spark, sf_dir)
    return out(_with_rejects(*I.score_origins(models, f, _origins(split), HORIZONS, MODEL_FEATURES)))


BANDS_SQL = f"""bands AS (SELECT series_id, method, horizon_step, quantile_cont(actual - forecast, 0.1) AS lower_err,
  quantile_cont(actual - forecast, 0.9) AS upper_err FROM bt WHERE actual IS NOT NULL AND forecast IS NOT NULL
  GROUP BY 1, 2, 3)"""


@register("i8_error_bands", f"""WITH {O.BT24}, {BANDS_SQL}
SELECT series_id, method, horizon_step, round(lower_err, {R}) AS lower_err, round(upper_err, {R}) AS upper_err FROM bands""")
def i8_error_bands(spark, sf_dir):
    return out(I.error_bands(hourly_backtest(spark, sf_dir)))


@register("i9_forecast_interval", f"""WITH {O.BT24}, {BANDS_SQL},
latest AS (SELECT series_id, max(ts) AS origin FROM hourly GROUP BY 1),
fc AS (SELECT l.series_id, l.origin, CAST(s.h AS INTEGER) AS horizon_step, 'daily_profile' AS method,
         h.y AS forecast
       FROM latest l CROSS JOIN (SELECT range AS h FROM range(1, 25)) s
       JOIN hourly h ON h.series_id = l.series_id AND h.ts = l.origin + INTERVAL 1 HOUR * (((s.h - 1) % 24) - 23)
       WHERE l.origin - INTERVAL 23 HOUR >= (SELECT min(ts) FROM hourly x WHERE x.series_id = l.series_id))
SELECT fc.series_id, fc.origin, fc.horizon_step, fc.method, round(forecast, {R}) AS forecast,
  round(lower_err, {R}) AS lower_err, round(upper_err, {R}) AS upper_err,
  round(forecast + lower_err, {R}) AS lower, round(forecast + upper_err, {R}) AS upper
FROM fc LEFT JOIN bands b ON fc.series_id = b.series_id AND fc.method = b.method AND fc.horizon_step = b.horizon_step""")
def i9_forecast_interval(spark, sf_dir):
    """Tiled-profile forecast issued at each series' latest hour, with empirical bands."""
    g = T.hourly_grid(spark, sf_dir)
    from ..sources.store import latest_origin
    bands = I.error_bands(hourly_backtest(spark, sf_dir, grid=g))
    origins = latest_origin(g).withColumnRenamed("as_of", "origin")
    fc = B.lookup_forecasts(g, origins, [B.tiled_profile(24)], 24)
    fc = fc.select("series_id", "origin", F.col("horizon_step").cast("int").alias("horizon_step"), "method", "forecast")
    return out(I.with_interval(fc, bands))


@register("i10_score_known", f"""WITH {O.BT24}
SELECT series_id, method, origin, round(avg(abs(actual - forecast)), {R}) AS mae, count(*) AS n_known FROM bt
WHERE actual IS NOT NULL AND forecast IS NOT NULL GROUP BY 1, 2, 3""")
def i10_score_known(spark, sf_dir):
    return out(I.score_known(hourly_backtest(spark, sf_dir)))


@register("i11_target_ts", f"""WITH {O.BT24}
SELECT series_id, origin, horizon_step, method, origin + INTERVAL 1 HOUR * horizon_step AS target_ts FROM bt""")
def i11_target_ts(spark, sf_dir):
    return I.target_ts(hourly_backtest(spark, sf_dir)).select("series_id", "origin", "horizon_step", "method",
                                                              "target_ts")


@register("i4_batch_forecast")
def i4_batch_forecast(spark, sf_dir):
    """Latest features → per-horizon forecasts → forecast sink, read back."""
    from ..sources.store import latest_origin, save_forecasts
    g, split, f, models = fit_models(spark, sf_dir)
    as_of = latest_origin(g).withColumnRenamed("as_of", "origin")
    fc = _with_rejects(*I.score_origins(models, f, as_of, HORIZONS, MODEL_FEATURES))
    root = scratch_path(spark, "batch-forecast")
    save_forecasts(I.target_ts(fc), root)
    return out(spark.read.parquet(root))


@register("i7_attach_actuals", f"""WITH {O.HOURLY},
o AS (SELECT series_id, max(ts) - INTERVAL 24 HOUR AS origin FROM hourly GROUP BY 1),
fc AS (SELECT o.series_id, o.origin, CAST(s.h AS INTEGER) AS horizon_step, 'daily_profile' AS method, h.y AS forecast
       FROM o CROSS JOIN (SELECT range AS h FROM range(1, 25)) s
       JOIN hourly h ON h.series_id = o.series_id AND h.ts = o.origin + INTERVAL 1 HOUR * (((s.h - 1) % 24) - 23)
       WHERE o.origin - INTERVAL 23 HOUR >= (SELECT min(ts) FROM hourly x WHERE x.series_id = o.series_id))
SELECT fc.series_id, fc.origin, fc.horizon_step, fc.method, round(a.y, {R}) AS actual, round(fc.forecast, {R}) AS forecast
FROM fc LEFT JOIN hourly a ON a.series_id = fc.series_id AND a.ts = fc.origin + INTERVAL 1 HOUR * fc.horizon_step""")
def i7_attach_actuals(spark, sf_dir):
    """Forecast issued one day before the end, joined with the actuals that arrived since."""
    g = T.hourly_grid(spark, sf_dir)
    o = g.groupBy("series_id").agg(add_steps(F.max("ts"), -24, "hour").alias("origin"))
    fc = B.lookup_forecasts(g, o, [B.tiled_profile(24)], 24)
    return out(B.attach_actuals(fc, g))


TUNING_SPACE = {"maxDepth": TU.Choice((3, 4, 5, 6)), "stepSize": TU.Between(0.02, 0.3, log=True), "minInstancesPerNode": TU.Choice((5, 10, 20, 40)),
                "subsamplingRate": TU.Between(0.6, 1.0, digits=2), "featureSubsetStrategy": TU.Choice(("all", "onethird", "sqrt"))}


@register("p5_tuning")
def p5_tuning(spark, sf_dir, trials: int = 20, seed: int = 42):
    """Adaptive search of boosted-tree parameters on a chronological hold-out (last 10 % of
    the training rows, no shuffling), one horizon (24): the trial table, best first."""
    g, split = _split(spark, sf_dir)
    sup = FE.supervised(model_features(spark, sf_dir, g), [24]).join(split.select("series_id", "test_start"), "series_id")
    train = FE.train_mask(sup, F.col("test_start"), MODEL_FEATURES)
    cut = materialize(B.chrono_split(train.drop("test_start"), 0.9, step="hour"))
    fit_rows, val_rows = cut.where(F.col("split") == "train"), cut.where(F.col("split") == "test")
    actual = val_rows.select("series_id", F.col("ts").alias("origin"), F.col("y_target").alias("actual"))

    def evaluate(params, rounds):
        m = MD.fit_direct(fit_rows, [24], MODEL_FEATURES, "gbt", {**params, "maxIter": rounds, "seed": seed})
        scored = MD.predict_direct(m, val_rows).join(actual, ["series_id", "origin"])
        return scored.agg(F.avg(F.abs(F.col("actual") - F.col("forecast")))).first()[0]

    table = TU.search(spark, evaluate, TUNING_SPACE, scratch_path(spark, "tuning"), trials, seed=seed)
    return out(table.withColumnRenamed("loss", "val_mae"))
