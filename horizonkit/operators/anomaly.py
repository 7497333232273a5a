"""Anomaly detection and flagged-day context."""

from __future__ import annotations

import json
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import all_not_null
from ..functions.timecols import day_of
from .halo import windowed
from .stats import decompose
from .stl import stl


def zscore(df: DataFrame, col: str = "y", threshold: float = 3.0, keys=("series_id",), name: str = "zscore_flag",
           keep_z: bool = True) -> DataFrame:
    """A1: global z-score per series (sample std); missing values are not flagged.
    Series statistics are a partial aggregate joined back (no whole-series window)."""
    keys = list(keys)
    st = df.groupBy(*keys).agg(F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd"))
    z = (F.col(col) - F.col("_mu")) / F.nullif(F.col("_sd"), F.lit(0.0))
    x = df.join(st, keys).withColumn("z", z)
    x = x.withColumn(name, F.coalesce(F.abs("z") > threshold, F.lit(False))).drop("_mu", "_sd")
    return x if keep_z else x.drop("z")


def residual_zscore(filled: DataFrame, col: str = "y", period: int = 7, threshold: float = 3.0, keys=("series_id",),
                    ts="ts", step="day", name: str = "resid_flag", method: str = "classical", **kw) -> DataFrame:
    """A2: z-score of the decomposition residual (period ``period``) on an
    interpolated series; ``method`` is ``classical`` or ``stl`` (robust)."""
    d = {"classical": decompose, "stl": stl}[method](filled, col, period, keys, ts, step, **kw)
    return zscore(d, "resid", threshold, keys, name)


def rolling_iqr(df: DataFrame, col: str = "y", n: int = 30, min_periods: int = 10, k: float = 1.5, keys=("series_id",),
                ts="ts", step="day", name: str = "iqr_flag", bucket_steps=None, bucketed=True) -> DataFrame:
    """A3: trailing window of n rows including the current, linear quartiles,
    flag outside [q1 - k·IQR, q3 + k·IQR]; windows with fewer than
    ``min_periods`` values never flag."""
    def mk(w):
        fr = w.rowsBetween(-(n - 1), 0)
        ok = F.count(col).over(fr) >= min_periods
        return [F.when(ok, F.percentile(col, 0.25).over(fr)).alias("q1"),
                F.when(ok, F.percentile(col, 0.75).over(fr)).alias("q3")]
    x = windowed(df, keys, ts, step, n - 1, 0, mk, bucket_steps, bucketed)
    iqr = F.col("q3") - F.col("q1")
    out = (F.col(col) < F.col("q1") - k * iqr) | (F.col(col) > F.col("q3") + k * iqr)
    return x.withColumn(name, F.coalesce(out, F.lit(False)))


def consensus(flags: Sequence[DataFrame], names: Sequence[str], keys=("series_id",), ts="ts",
              min_methods: int = 2) -> DataFrame:
    """A5: outer-join per-method flag tables on (keys, ts); count methods that
    flag each row and keep rows flagged by at least ``min_methods``."""
    keys = list(keys)
    j = None
    for f, n in zip(flags, names):
        t = f.select(*keys, ts, F.col(n))
        j = t if j is None else j.join(t, [*keys, ts], "full")
    cnt = sum(F.coalesce(F.col(n), F.lit(False)).cast("int") for n in names)
    j = j.select(*keys, ts, *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in names],
                 cnt.alias("n_methods_flagged"))
    return j.where(F.col("n_methods_flagged") >= min_methods)


def split_known(flagged: DataFrame, known_days: DataFrame, ts: str = "ts", keys=("series_id",)) -> DataFrame:
    """Mark flagged days that are known data gaps (``is_known_gap``): of the same
    series where the table of days has the key columns, else of all series."""
    of = [k for k in keys if k in known_days.columns]
    k = known_days.select(*of, day_of("day").alias("_kd")).distinct().withColumn("is_known_gap", F.lit(True))
    x = flagged.withColumn("_kd", day_of(ts)).join(k, [*of, "_kd"], "left").select(*flagged.columns, "_kd", "is_known_gap")
    return x.withColumn("is_known_gap", F.coalesce("is_known_gap", F.lit(False))).drop("_kd")


def with_calendar(flagged: DataFrame, holidays: DataFrame, ts: str = "ts") -> DataFrame:
    """Weekday name, month and holiday membership of flagged days."""
    h = holidays.select(F.col("day").alias("_hd")).distinct().withColumn("is_holiday", F.lit(True))
    x = flagged.withColumn("_hd", day_of(ts)).join(h, "_hd", "left")
    return (x.withColumn("weekday", F.date_format(ts, "EEEE")).withColumn("month", F.month(ts))
             .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False))).drop("_hd"))


def flagged_detail(daily: DataFrame, flagged_days: DataFrame, col: str = "y", keys=("series_id",),
                   ts: str = "ts") -> DataFrame:
    """Daily mean of flagged days, difference to the series mean and
    direction; a positive difference is 'high', anything else (including a
    missing value) 'low'."""
    keys = list(keys)
    m = daily.groupBy(*keys).agg(F.avg(col).alias("overall_mean"))
    f = flagged_days.select(*keys, ts).distinct()
    x = daily.join(f, [*keys, ts], "left_semi").join(m, keys)
    diff = F.col(col) - F.col("overall_mean")
    return x.select(*keys, ts, F.col(col).alias("daily_mean"), "overall_mean", diff.alias("diff"),
                    F.when(diff > 0, "high").otherwise("low").alias("direction"))


# ---------------------------------------------------------------- A4 isolation forest
def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(X: np.ndarray, rng: np.random.Generator, depth: int, limit: int) -> dict:
    n = X.shape[0]
    if depth >= limit or n <= 1:
        return {"s": int(n)}
    lo, hi = X.min(axis=0), X.max(axis=0)
    cand = np.where(hi > lo)[0]
    if len(cand) == 0:
        return {"s": int(n)}
    f = int(rng.choice(cand))
    t = float(rng.uniform(lo[f], hi[f]))
    m = X[:, f] < t
    return {"f": f, "t": t, "l": _grow(X[m], rng, depth + 1, limit), "r": _grow(X[~m], rng, depth + 1, limit)}


def _paths(tree: dict, X: np.ndarray, idx: np.ndarray, depth: int, out: np.ndarray) -> None:
    """Path length of every row of X[idx] through one tree (vectorised per node)."""
    if "s" in tree:
        out[idx] = depth + _c(tree["s"])
        return
    m = X[idx, tree["f"]] < tree["t"]
    _paths(tree["l"], X, idx[m], depth + 1, out)
    _paths(tree["r"], X, idx[~m], depth + 1, out)


def isolation_forest(df: DataFrame, cols: Sequence[str], contamination: float = 0.02, n_trees: int = 100,
                     sample_size: int = 256, seed: int = 42, keys=("series_id",), ts="ts",
                     name: str = "iforest_flag") -> DataFrame:
    """A4: isolation forest on complete rows of ``cols`` (already scaled, F13).

    * per tree the ``sample_size`` rows with the lowest hash of (keys, ts, tree):
      the same rows whatever the input's size, order and partitions; hashes over
      ``1.75 × sample_size + 64`` expected rows are dropped before the ranking;
    * each tree is grown in ``groupBy(tree_id).applyInPandas`` (≤ a few
      hundred rows per group);
    * the forest (n_trees small JSON strings, size bounded by
      n_trees × sample_size nodes) is broadcast and every row is scored in an
      Arrow-batched pandas UDF;
    * rows whose score is at or above the (1 - contamination) quantile are
      flagged; rows with a missing feature are not flagged.
    """
    keys = list(keys)
    cols = list(cols)
    complete = df.where(all_not_null(cols))
    total = complete.count()
    if total == 0:
        return df.withColumn("iforest_score", F.lit(None).cast("double")).withColumn(name, F.lit(False))
    limit = int(np.ceil(np.log2(max(sample_size, 2))))
    u = lambda t: F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys], F.col(ts), F.lit(seed), t), 11) / F.lit(2.0 ** 53)
    most = min(1.0, (1.75 * sample_size + 64) / total)
    trees_of = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: u(t) <= most)
    rank = F.row_number().over(Window.partitionBy("tree_id").orderBy(u(F.col("tree_id")), *keys, ts, *cols))
    samp = (complete.withColumn("tree_id", F.explode(trees_of)).withColumn("_rank", rank)
            .where(F.col("_rank") <= sample_size).select("tree_id", *cols))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        X = pdf[cols].to_numpy(dtype="float64")
        rng = np.random.default_rng(seed * 100003 + tid)
        return pd.DataFrame({"tree_id": [tid], "n": [len(X)], "tree": [json.dumps(_grow(X, rng, 0, limit))]})

    trees = samp.groupBy("tree_id").applyInPandas(grow, "tree_id int, n int, tree string").collect()
    forest = [(json.loads(r["tree"]), r["n"]) for r in sorted(trees, key=lambda r: r["tree_id"])]
    bc = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf(T.DoubleType())
    def score(*cs: pd.Series) -> pd.Series:
        fr = bc.value
        X = np.column_stack([c.to_numpy(dtype="float64") for c in cs])
        out = np.full(len(X), np.nan)
        idx = np.where(~np.isnan(X).any(axis=1))[0]
        total = np.zeros(len(X))
        buf = np.zeros(len(X))
        for t, _ in fr:
            _paths(t, X, idx, 0, buf)
            total[idx] += buf[idx]
        cn = np.mean([_c(n) for _, n in fr])
        if cn > 0:
            out[idx] = 2.0 ** (-(total[idx] / len(fr)) / cn)
        return pd.Series(out)

    x = df.withColumn("iforest_score", score(*[F.col(c) for c in cols]))
    from ..functions.quantiles import exact_quantiles
    thr = exact_quantiles(x, [], "iforest_score", [1.0 - contamination], names=["_thr"])
    x = x.withColumn("_one", F.lit(1)).join(F.broadcast(thr.withColumn("_one", F.lit(1))), "_one").drop("_one")
    return x.withColumn(name, F.coalesce(F.col("iforest_score") >= F.col("_thr"), F.lit(False))).drop("_thr")
