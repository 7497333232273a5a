"""Forecast models re-aimed as Spark jobs.

* Seasonal AR models are fit
  from normal equations: one aggregation of cross-products per series
  (partial + final, any series size), then a tiny solve per series on the
  moment table (k×k numbers per series).
* Direct multi-horizon boosted trees use Spark ML (``GBTRegressor``), one
  pipeline per horizon, or one pooled pipeline with the horizon as a feature.
* Multi-step AR forecasts run as a higher-order ``aggregate`` over an array
  (no Python per row).
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import all_not_null
from .halo import windowed


# ---------------------------------------------------------------- per-series least squares
def normal_equations(df: DataFrame, keys: Sequence[str], x_cols: Sequence[str], y_col: str) -> DataFrame:
    """Sums of cross products per series: ``_xx_i_j`` (i<=j), ``_xy_i``, ``_yy``, ``_n``."""
    keys, x_cols = list(keys), list(x_cols)
    d = df.where(all_not_null([*x_cols, y_col]))
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"_xx_{i}_{j}") for i, a in enumerate(x_cols)
            for j, b in enumerate(x_cols) if j >= i]
    aggs += [F.sum(F.col(a) * F.col(y_col)).alias(f"_xy_{i}") for i, a in enumerate(x_cols)]
    aggs += [F.sum(F.col(y_col) * F.col(y_col)).alias("_yy"), F.count(F.lit(1)).alias("_n")]
    return d.groupBy(*keys).agg(*aggs)


def solve_per_series(moments: DataFrame, keys: Sequence[str], k: int, ridge: float = 0.0) -> DataFrame:
    """Solve (X'X + ridge·I) β = X'y per series → ``keys, coef array<double>, rss, n``."""
    keys = list(keys)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            A = np.zeros((k, k))
            for i in range(k):
                for j in range(i, k):
                    A[i, j] = A[j, i] = r[f"_xx_{i}_{j}"]
            b = np.array([r[f"_xy_{i}"] for i in range(k)], dtype="float64")
            reg = np.eye(k) * ridge
            reg[0, 0] = 0.0  # intercept is not penalised
            try:
                beta = np.linalg.solve(A + reg, b)
            except np.linalg.LinAlgError:
                beta = np.linalg.lstsq(A + reg, b, rcond=None)[0]
            rss = float(r["_yy"] - 2 * beta @ b + beta @ A @ beta)
            rows.append({**{kk: r[kk] for kk in keys}, "coef": beta.tolist(), "rss": rss, "n": int(r["_n"])})
        return pd.DataFrame(rows, columns=[*keys, "coef", "rss", "n"])

    schema = ", ".join(f"{kk} string" for kk in keys) + ", coef array<double>, rss double, n long"
    return moments.groupBy(*keys).applyInPandas(solve, schema)


def dot(coef: Column, xs: Sequence[Column]) -> Column:
    out = None
    for i, x in enumerate(xs):
        t = F.element_at(coef, i + 1) * x
        out = t if out is None else out + t
    return out


# ---------------------------------------------------------------- P1, P2, B13: seasonal AR on Δy
def ar_lags(p: int, P: int, m: int) -> list[int]:
    """Lags of the expanded (1-φ(B))(1-Φ(B^m)) polynomial: 1..p, m·j .. m·j+p."""
    lags = set(range(1, p + 1))
    for j in range(1, P + 1):
        for i in range(0, p + 1):
            lags.add(m * j + i)
    return sorted(lags)


def fit_ar(df: DataFrame, p: int = 3, P: int = 2, m: int = 24, col: str = "y", keys=("series_id",), ts="ts",
           step="hour", d: int = 1, ridge: float = 0.0) -> DataFrame:
    """Least-squares seasonal AR on the d-th difference (d ∈ {0, 1}) with
    an intercept; rows with a missing lag are dropped (documented deviation
    from a Kalman-filtered likelihood). Returns ``keys, coef, rss, n, aic`` and
    the lag list in ``lags``."""
    keys = list(keys)
    lags = ar_lags(p, P, m)
    L = max(lags)

    def mk(w):
        z = (F.col(col) - F.lag(col, 1).over(w)) if d == 1 else F.col(col)
        out = [z.alias("_z")]
        for k in lags:
            zk = (F.lag(col, k).over(w) - F.lag(col, k + 1).over(w)) if d == 1 else F.lag(col, k).over(w)
            out.append(zk.alias(f"_z{k}"))
        return out

    x = windowed(df, keys, ts, step, L + d, 0, mk).withColumn("_one", F.lit(1.0))
    xc = ["_one"] + [f"_z{k}" for k in lags]
    mom = normal_equations(x, keys, xc, "_z")
    fit = solve_per_series(mom, keys, len(xc), ridge)
    k = len(xc) + 1  # + noise variance
    aic = F.col("n") * F.log(F.col("rss") / F.col("n")) + 2 * k
    return fit.withColumn("aic", aic).withColumn("lags", F.array(*[F.lit(v) for v in lags]))


def ar_forecast_expr(hist: Column, coef: Column, lags: Sequence[int], horizon: int, d: int = 1) -> Column:
    """Recursive multi-step forecast as a higher-order function.

    ``hist`` holds the last values of y (oldest first). For d=1 the state is
    the array of differences; each step appends ``c0 + Σ c_k · z[t-k]``; the
    level forecast is the origin value plus the cumulative sum of predicted
    differences."""
    if d == 1:
        z0 = F.transform(F.slice(hist, 2, 1_000_000), lambda v, i: v - F.element_at(hist, i + 1))
    else:
        z0 = hist

    def step_fn(acc, _):
        n = F.size(acc)
        pred = F.element_at(coef, 1)
        for j, k in enumerate(lags):
            pred = pred + F.element_at(coef, j + 2) * F.element_at(acc, n - k + 1)
        return F.concat(acc, F.array(pred))

    full = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), z0, step_fn)
    preds = F.slice(full, F.size(z0) + 1, horizon)
    if d == 1:
        last = F.element_at(hist, -1)
        return F.transform(preds, lambda v, i: last + F.aggregate(F.slice(preds, 1, i + 1), F.lit(0.0),
                                                                    lambda a, b: a + b))
    return preds


def ar_backtest(df: DataFrame, fit: DataFrame, origins: DataFrame, horizon: int, lags: Sequence[int],
                method: str = "seasonal_ar", window: int | None = None, col="y", keys=("series_id",), ts="ts",
                step="hour", d: int = 1) -> DataFrame:
    """Parameters frozen; at each origin the last ``max(lag)+d+1`` values
    (``window`` to widen) feed the recursion. Origins whose history has a gap
    are skipped. Output: keys, origin, horizon_step, method, forecast."""
    keys = list(keys)
    need = max(lags) + d + 1
    L = max(need, window or 0)
    x = windowed(df.select(*keys, ts, col), keys, ts, step, L - 1, 0,
                 lambda w: [F.collect_list(col).over(w.rowsBetween(-(L - 1), 0)).alias("_hist")])
    x = x.join(origins.select(*keys, F.col("origin").alias(ts)), [*keys, ts], "left_semi")
    x = x.where(F.size("_hist") == L).withColumn("_hist", F.slice("_hist", L - need + 1, need))
    x = x.join(fit.select(*keys, "coef"), keys)
    fc = ar_forecast_expr(F.col("_hist"), F.col("coef"), lags, horizon, d)
    return x.select(*keys, F.col(ts).alias("origin"), F.lit(method).alias("method"),
                    F.posexplode(fc).alias("_i", "forecast")) \
            .select(*keys, "origin", (F.col("_i") + 1).cast("int").alias("horizon_step"), "method", "forecast")


# ---------------------------------------------------------------- P4, P7, B11: direct multi-horizon trees
CATEGORICAL = ("season",)
#: Rows of a task of a fit. A boosted tree is some six short jobs, so each partition more costs
#: that many task starts a tree.
FIT_ROWS = 50_000


def _regressor(learner: str, params: dict, features: str = "features", label: str = "y_target"):
    p = dict(params or {})
    if learner == "gbt":
        return GBTRegressor(featuresCol=features, labelCol=label, maxIter=p.get("maxIter", 20),
                            stepSize=p.get("stepSize", 0.1), maxDepth=p.get("maxDepth", 5),
                            minInstancesPerNode=p.get("minInstancesPerNode", 20),
                            subsamplingRate=p.get("subsamplingRate", 1.0),
                            featureSubsetStrategy=p.get("featureSubsetStrategy", "all"), seed=p.get("seed", 42),
                            maxBins=p.get("maxBins", 64))
    if learner == "rf":
        return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=p.get("numTrees", 20),
                                     maxDepth=p.get("maxDepth", 8), seed=p.get("seed", 42))
    if learner == "linear":
        return LinearRegression(featuresCol=features, labelCol=label, regParam=p.get("regParam", 0.0))
    raise ValueError(f"unknown learner {learner!r}")


def direct_pipeline(feature_cols: Sequence[str], learner: str = "gbt", params: dict | None = None) -> Pipeline:
    """StringIndexer for categorical columns (kept inside the saved pipeline so a
    one-row input with fewer categories predicts the same) → assembler → regressor."""
    cats = [c for c in feature_cols if c in CATEGORICAL]
    nums = [c for c in feature_cols if c not in CATEGORICAL]
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in cats]
    stages.append(VectorAssembler(inputCols=nums + [f"{c}_idx" for c in cats], outputCol="features",
                                  handleInvalid="skip"))
    stages.append(_regressor(learner, params or {}))
    return Pipeline(stages=stages)


def fit_direct(train_sup: DataFrame, horizons: Sequence[int], feature_cols: Sequence[str], learner: str = "gbt",
               params: dict | None = None, pooled: bool = False, parallelism: int = 4) -> dict:
    """One model per horizon (independent fits submitted concurrently from
    driver threads), or one pooled model with ``horizon`` as a feature.
    ``train_sup`` is the F9-masked supervised frame (persisted by the caller). A fit's own
    rows are cached while it lasts (it reads them several times before its first tree), in
    as many partitions as they need, whatever the files they come from."""
    def fit(rows, features):
        rows = rows.select(*dict.fromkeys([*features, "y_target"]))
        rows = rows.coalesce(max(1, -(-rows.count() // FIT_ROWS))).persist()
        try:
            return direct_pipeline(features, learner, params).fit(rows)
        finally:
            rows.unpersist()

    if pooled:
        return {"pooled": fit(train_sup.where(F.col("horizon").isin(list(horizons))), [*feature_cols, "horizon"])}

    def fit_one(h):
        return h, fit(train_sup.where(F.col("horizon") == h), feature_cols)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(horizons)))) as ex:
        return dict(ex.map(fit_one, list(horizons)))


def predict_direct(models: dict, sup_rows: DataFrame, keys=("series_id",), ts="ts", method: str = "gbt_direct",
                   step="hour") -> DataFrame:
    """One forecast row per (row, horizon); rows with a missing feature
    are skipped by the assembler. Output: keys, origin, horizon_step, method, forecast."""
    keys = list(keys)
    if "pooled" in models:
        parts = [models["pooled"].transform(sup_rows)]
    else:
        parts = [m.transform(sup_rows.where(F.col("horizon") == h)) for h, m in models.items()]
    out = parts[0].select(*keys, ts, "horizon", "prediction")
    for p in parts[1:]:
        out = out.unionByName(p.select(*keys, ts, "horizon", "prediction"))
    return out.select(*keys, F.col(ts).alias("origin"), F.col("horizon").cast("int").alias("horizon_step"),
                      F.lit(method).alias("method"), F.col("prediction").alias("forecast"))


def feature_importance(models: dict, feature_cols: Sequence[str], spark: SparkSession, top_k: int = 20) -> DataFrame:
    """Tree feature importances per horizon, long form with rank (top-k)."""
    rows = []
    cats = [c for c in feature_cols if c in CATEGORICAL]
    names = [c for c in feature_cols if c not in CATEGORICAL] + cats
    for h, m in models.items():
        reg = m.stages[-1]
        if not hasattr(reg, "featureImportances"):
            continue
        imp = reg.featureImportances.toArray()
        order = np.argsort(-imp, kind="stable")
        for r, i in enumerate(order[:top_k]):
            rows.append((str(h), names[i] if i < len(names) else f"f{i}", float(imp[i]), r + 1))
    return spark.createDataFrame(rows, "horizon string, feature string, importance double, rank int")


def permutation_importance(models: dict, rows: DataFrame, feature_cols: Sequence[str], h: int, seed: int = 42,
                           keys=("series_id",), ts="ts", n_blocks: int = 64) -> DataFrame:
    """P8 (re-aimed): MAE increase when one feature column is shuffled: within each of
    ``n_blocks`` hash blocks of rows, values move along the order of a seeded hash."""
    keys = list(keys)
    from pyspark.sql import Window
    base_rows = rows.where(F.col("horizon") == h).where(all_not_null([*feature_cols, "y_target"]))
    m = models[h]
    error = F.avg(F.abs(F.col("prediction") - F.col("y_target")))
    base = m.transform(base_rows).agg(error).first()[0]
    row = [F.col(k) for k in [*keys, ts]]
    idx = base_rows.withColumn("_blk", F.pmod(F.xxhash64(*row, F.lit(seed)), F.lit(n_blocks)))
    out = []
    for i, c in enumerate(feature_cols):
        w = Window.partitionBy("_blk").orderBy(F.xxhash64(*row, F.lit(seed + 1 + i)), *keys, ts)
        whole = Window.partitionBy("_blk").orderBy(F.xxhash64(*row, F.lit(seed + 1 + i)), *keys, ts).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        shuffled = idx.withColumn(c, F.coalesce(F.lead(c).over(w), F.first(c).over(whole)))
        mae = m.transform(shuffled).agg(error).first()[0]
        out.append((c, float(mae - base) if mae is not None else None))
    return rows.sparkSession.createDataFrame(out, "feature string, mae_increase double")


# ---------------------------------------------------------------- P9, P10
def mutual_info(df: DataFrame, feature_cols: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """P9 (re-aimed): binned mutual information feature ↔ target, equal-width
    bins from each column's min/max; joint counts are one aggregation."""
    d = df.where(all_not_null([*feature_cols, target]))
    rng = d.agg(*[F.min(c).alias(f"_lo_{c}") for c in [*feature_cols, target]],
                *[F.max(c).alias(f"_hi_{c}") for c in [*feature_cols, target]])
    x = d.withColumn("_one", F.lit(1)).join(F.broadcast(rng.withColumn("_one", F.lit(1))), "_one")

    def binc(c):
        w = (F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) / bins
        b = F.floor((F.col(c) - F.col(f"_lo_{c}")) / F.nullif(w, F.lit(0.0)))
        return F.coalesce(F.least(b, F.lit(bins - 1)), F.lit(0)).cast("int")

    # one pass: every row emits one (feature, bin_x) pair per feature
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), binc(c).alias("bin_x")) for c in feature_cols])
    allj = x.select(binc(target).alias("bin_y"), F.inline(pairs))
    joint = allj.groupBy("feature", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("nxy"))
    from pyspark.sql import Window
    wf = Window.partitionBy("feature")
    joint = (joint.withColumn("n", F.sum("nxy").over(wf))
                  .withColumn("nx", F.sum("nxy").over(Window.partitionBy("feature", "bin_x")))
                  .withColumn("ny", F.sum("nxy").over(Window.partitionBy("feature", "bin_y"))))
    term = (F.col("nxy") / F.col("n")) * F.log((F.col("nxy") * F.col("n")) / (F.col("nx") * F.col("ny")))
    return joint.groupBy("feature").agg(F.sum(term).alias("mutual_info"))


def compare_ranks(a: DataFrame, b: DataFrame, col_a: str, col_b: str) -> DataFrame:
    """P10: average-tie descending ranks of two importance measures side by side."""
    from pyspark.sql import Window

    def avg_rank(df, col):
        w = Window.orderBy(F.desc(col))
        ties = Window.partitionBy(col)
        return df.withColumn(f"rank_{col}", F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0)

    return avg_rank(a, col_a).join(avg_rank(b, col_b), "feature")


# ---------------------------------------------------------------- P6, B12: window regression
def fit_window_linear(win: DataFrame, lookback: int, horizon: int, ridge: float = 0.01) -> dict:
    """P6 (re-aimed): one linear map from the (scaled) target channel of the
    look-back window to all ``horizon`` steps, pooled over series.

    Two JVM-side passes over the window table — ``Summarizer`` (count, means,
    variances) and ``Correlation`` of the stacked vector [x_1..x_L, y_1..y_H] —
    give every cross moment; the (L+H)² system is solved on the driver
    (size fixed by the window shape, not by the data). Ridge acts on
    standardised inputs, the intercept is not penalised."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation, Summarizer
    xs = F.transform("x_window", lambda r: F.element_at(r, 1))
    v = win.select(array_to_vector(F.concat(xs, F.col("y_window"))).alias("v"))
    summ = v.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")).first()["s"]
    mean, var, n = summ["mean"].toArray(), summ["variance"].toArray(), float(summ["count"])
    corr = Correlation.corr(v, "v").first()[0].toArray()
    sd = np.sqrt(var)
    cov = corr * np.outer(sd, sd)
    L = lookback
    sxx, sxy = cov[:L, :L], cov[:L, L:]
    sxx = np.nan_to_num(sxx) + ridge * np.diag(np.where(var[:L] > 0, var[:L], 1.0))
    beta = np.linalg.solve(sxx, np.nan_to_num(sxy))           # L × H
    intercept = mean[L:] - mean[:L] @ beta                     # H
    return {"beta": beta.T.tolist(), "intercept": intercept.tolist(), "n": n}


def predict_window_linear(fit: dict, win: DataFrame, keys=("series_id",), method: str = "window_linear") -> DataFrame:
    """Forecast rows (scaled units) for every window: one dot product per step,
    evaluated as array expressions (coefficients are literals of fixed size)."""
    keys = list(keys)
    xs = F.transform("x_window", lambda r: F.element_at(r, 1))
    preds = []
    for h, (b, c) in enumerate(zip(fit["beta"], fit["intercept"]), start=1):
        coef = F.array(*[F.lit(float(w)) for w in b])
        dotp = F.aggregate(F.zip_with(xs, coef, lambda a, w: a * w), F.lit(0.0), lambda acc, t: acc + t)
        preds.append(F.struct(F.lit(h).alias("horizon_step"), (dotp + F.lit(float(c))).alias("_z")))
    return win.select(*keys, "origin", F.inline(F.array(*preds))).withColumn("method", F.lit(method))
