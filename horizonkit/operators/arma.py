"""Seasonal ARMA models of differences by two-stage least squares (P2, B13 with MA terms).

Hannan and Rissanen's estimation: a long autoregression gives residuals, and a second
regression on lags of both the differences and the residuals gives the AR and MA
coefficients. Every candidate order's regressors are among those of the largest one, so
one moment matrix per series, summed over time buckets, serves the whole search: orders
are compared on a common sample by solving its sub-matrices.

Lags are steps of the grid; a missing step leaves out the observations that need it."""

from __future__ import annotations

from itertools import product
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import epoch_seconds, step_seconds
from .halo import B_COL, OWN_COL, windowed, with_halo

ORDER = ("ar_order", "ma_order", "seasonal_ar_order", "seasonal_ma_order")


def lags_of(p: int, seasonal: int, m: int) -> list[int]:
    """Lags of (1 + .. B^p)(1 + .. B^(m * seasonal)) without lag 0."""
    return sorted({m * j + i for j in range(seasonal + 1) for i in range(p + 1)} - {0})


def long_lags(m: int, most: int) -> list[int]:
    """Lags of the first regression: a season and a little more, and around the later
    seasons, three beyond lag ``most`` (what lies beyond biases strong MA terms)."""
    return sorted({*range(1, m + 5), *(k for j in range(1, most // m + 4) for k in range(max(1, m * j - 2), m * j + 5))})


def _lagged(x: np.ndarray, lag: int) -> np.ndarray:
    return np.concatenate([np.full(min(lag, len(x)), np.nan), x[:max(0, len(x) - lag)]])


def _design(z: np.ndarray, e: np.ndarray, ar: Sequence[int], ma: Sequence[int]) -> np.ndarray:
    return np.column_stack([np.ones(len(z)), *(_lagged(z, k) for k in ar), *(_lagged(e, k) for k in ma), z])


def _residuals(z: np.ndarray, coef: np.ndarray, lags: Sequence[int]) -> np.ndarray:
    return z - coef[0] - sum(c * _lagged(z, k) for c, k in zip(coef[1:], lags))


def _moments(x: DataFrame, keys: list[str], step, reach: int, ar: list[int], ma: list[int], long: list[int]) -> DataFrame:
    """(keys, i, j, v): sums of products of the columns of ``_design``, and their number at
    (-1, -1). ``x``: keys, ts seconds ``s``, y, bucket, own, and with MA terms ``coef``."""
    schema = T.StructType([*(f for f in x.schema.fields if f.name in keys), *(T.StructField(c, t) for c, t in (
        ("i", T.IntegerType()), ("j", T.IntegerType()), ("v", T.DoubleType())))])
    st = step_seconds(step)

    def fn(part: pd.DataFrame) -> pd.DataFrame:
        first = int(part["s"].min())
        at = ((part["s"].to_numpy() - first) // st).astype(np.int64)
        y, own = np.full(at.max() + 1, np.nan), np.zeros(at.max() + 1, bool)
        y[at], own[at] = part["y"].to_numpy(float), part["own"].to_numpy()
        z = y - _lagged(y, 1)
        e = _residuals(z, np.asarray(part["coef"].iloc[0], float), long) if ma else z
        rows = _design(z, e, ar, ma)
        rows = rows[own & np.isfinite(rows).all(axis=1)]
        m = rows.T @ rows
        i, j = np.triu_indices(len(m))
        frame = pd.DataFrame({"i": np.append(i, -1), "j": np.append(j, -1), "v": np.append(m[i, j], len(rows))})
        for k in reversed(keys):
            frame.insert(0, k, part[k].iloc[0])
        return frame

    return x.groupBy(*keys, B_COL).applyInPandas(fn, schema).groupBy(*keys, "i", "j").agg(F.sum("v").alias("v"))


def _matrix(cells: pd.DataFrame) -> tuple[np.ndarray, int]:
    size = int(cells["j"].max()) + 1
    m, n = np.zeros((size, size)), 0
    for i, j, v in zip(cells["i"], cells["j"], cells["v"]):
        if i < 0:
            n = int(round(v))
        else:
            m[i, j] = m[j, i] = v
    return m, n


def _solve(m: np.ndarray, use: list[int]) -> tuple[np.ndarray, float]:
    """Coefficients and residual sum of squares of the last column on the columns ``use``."""
    a, c, yy = m[np.ix_(use, use)], m[use, -1], m[-1, -1]
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    beta = np.linalg.lstsq(a / np.outer(scale, scale), c / scale, rcond=1e-12)[0] / scale
    return beta, max(0.0, float(yy - 2 * c @ beta + beta @ a @ beta))


def _prepared(df: DataFrame, col: str, keys: list[str], ts: str, step, reach: int, bucket_steps: int | None) -> DataFrame:
    x = with_halo(df.select(*keys, ts, F.col(col).cast("double").alias("y")), ts, step, reach, 0, bucket_steps)
    return x.select(*keys, epoch_seconds(ts).alias("s"), "y", B_COL, F.col(OWN_COL).alias("own"))


def search_arma(df: DataFrame, max_p: int = 3, max_q: int = 3, max_P: int = 2, max_Q: int = 2, m: int = 24, criterion: str = "aic",
                col: str = "y", keys: Sequence[str] = ("series_id",), ts: str = "ts", step="hour", bucket_steps: int | None = None,
                trace: bool = False) -> DataFrame:
    """The order (p, 1, q)(P, 0, Q)m of least AIC (or ``bic``) per series, of all with
    p, q, P, Q up to their bounds: keys, the four orders, ``n``, ``rss``, ``aic``, ``bic``,
    ``ar_lags``, ``ma_lags``, ``coef`` (constant, AR, MA), and ``long_coef``, ``long_lags``
    of the first regression. With ``trace`` every order compared, one row each.

    A series with fewer observations than twice the regressors of the largest order gets
    no row; one that an order explains without error takes the smallest such order."""
    keys = list(keys)
    ar, ma = lags_of(max_p, max_P, m), lags_of(max_q, max_Q, m)
    long = long_lags(m, max(ar[-1:] + ma[-1:] + [m]))
    key_fields = [f for f in df.schema.fields if f.name in keys]
    first = _moments(_prepared(df, col, keys, ts, step, long[-1] + 1, bucket_steps), keys, step, long[-1] + 1, long, [], long)
    coef_schema = T.StructType([*key_fields, T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def solve_long(cells: pd.DataFrame) -> pd.DataFrame:
        mat, n = _matrix(cells)
        if n < 2 * len(mat):
            return pd.DataFrame(columns=coef_schema.fieldNames())
        return pd.DataFrame([{**{k: cells[k].iloc[0] for k in keys}, "coef": _solve(mat, list(range(len(mat) - 1)))[0].tolist()}])

    coefs = first.groupBy(*keys).applyInPandas(solve_long, coef_schema)  # one row per pair of regressors
    reach = long[-1] + 1 + max(ma[-1:] + [0])
    second = _moments(_prepared(df, col, keys, ts, step, max(reach, ar[-1] + 1 if ar else 1), bucket_steps).join(coefs, keys), keys, step, reach, ar, ma, long)
    place = {**{("ar", k): 1 + i for i, k in enumerate(ar)}, **{("ma", k): 1 + len(ar) + i for i, k in enumerate(ma)}}
    orders = list(product(range(max_p + 1), range(max_q + 1), range(max_P + 1), range(max_Q + 1)))
    out_schema = T.StructType([*key_fields, *(T.StructField(o, T.IntegerType()) for o in ORDER), T.StructField("n", T.LongType()),
                               *(T.StructField(c, T.DoubleType()) for c in ("rss", "aic", "bic")),
                               *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("ar_lags", "ma_lags")), T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def choose(cells: pd.DataFrame) -> pd.DataFrame:
        mat, n = _matrix(cells)
        rows = []
        for order in orders if n >= 2 * len(mat) else ():
            p, q, P, Q = order
            ar_l, ma_l = lags_of(p, P, m), lags_of(q, Q, m)
            beta, rss = _solve(mat, [0, *(place["ar", k] for k in ar_l), *(place["ma", k] for k in ma_l)])
            rss = max(rss, 1e-12 * mat[-1, -1], 1e-300)
            k = len(beta) + 1
            fit = n * np.log(rss / n)
            rows.append([cells[c].iloc[0] for c in keys] + [*order, n, rss, fit + 2 * k, fit + np.log(n) * k, ar_l, ma_l, beta.tolist()])
        out = pd.DataFrame(rows, columns=out_schema.fieldNames())
        if trace or not len(out):
            return out
        size = out["coef"].map(len)
        return out.assign(_k=size).sort_values([criterion, "_k", *ORDER], kind="stable").head(1).drop(columns="_k")

    chosen = second.groupBy(*keys).applyInPandas(choose, out_schema)
    return chosen.join(coefs.withColumnRenamed("coef", "long_coef"), keys).withColumn("long_lags", F.array(*map(F.lit, long)))


def arma_backtest(df: DataFrame, fit: DataFrame, origins: DataFrame, horizon: int, method: str = "seasonal_arma",
                  col: str = "y", keys: Sequence[str] = ("series_id",), ts: str = "ts", step="hour", bucket_steps: int | None = None) -> DataFrame:
    """Forecasts of ``search_arma`` models with frozen parameters. At each origin the
    last steps give the residuals, which then continue as zeros while the differences
    recur. An origin whose history has a gap gives no rows. Output: keys, origin,
    horizon_step, method, forecast."""
    keys = list(keys)
    schema = _forecast_schema(df, keys, ts)
    reach = fit.agg(F.max(F.array_max("long_lags") + F.coalesce(F.array_max("ma_lags"), F.lit(0))).alias("e"), F.max(F.array_max("ar_lags")).alias("z")).first()
    if reach.e is None:
        return df.sparkSession.createDataFrame([], schema)
    need = max(reach.e, reach.z or 0) + 2
    x = windowed(df.select(*keys, ts, F.col(col).cast("double").alias("_y")), keys, ts, step, need - 1, 0,
                 lambda w: [F.collect_list("_y").over(w.rowsBetween(-(need - 1), 0)).alias("hist"),
                            (epoch_seconds(ts) - F.min(epoch_seconds(ts)).over(w.rowsBetween(-(need - 1), 0))).alias("span")], bucket_steps)
    at = x.join(origins.select(*keys, F.col("origin").alias(ts)), [*keys, ts], "left_semi")
    at = at.where((F.size("hist") == need) & (F.col("span") == (need - 1) * step_seconds(step)))
    rows = at.join(fit.select(*keys, "ar_lags", "ma_lags", "coef", "long_lags", "long_coef"), keys).withColumnRenamed(ts, "origin")

    def fn(batches):
        for part in batches:
            out = []
            for r in part.itertuples(index=False):  # origins; the recursion itself is on short arrays
                y = np.asarray(r.hist, float)
                z = np.diff(y)
                e = np.nan_to_num(_residuals(z, np.asarray(r.long_coef, float), r.long_lags))
                z, e = np.concatenate([z, np.zeros(horizon)]), np.concatenate([e, np.zeros(horizon)])
                ar, ma, c = np.asarray(r.ar_lags, int), np.asarray(r.ma_lags, int), np.asarray(r.coef, float)
                for t in range(len(y) - 1, len(z)):
                    z[t] = c[0] + c[1:1 + len(ar)] @ z[t - ar] + c[1 + len(ar):] @ e[t - ma]
                out.append(y[-1] + np.cumsum(z[len(y) - 1:]))
            if out:
                base = part[[*keys, "origin"]]
                frame = base.loc[base.index.repeat(horizon)].reset_index(drop=True)
                frame["horizon_step"] = np.tile(np.arange(1, horizon + 1, dtype="int32"), len(out))
                frame["method"], frame["forecast"] = method, np.concatenate(out)
                yield frame

    return rows.mapInPandas(fn, schema)


def _forecast_schema(df: DataFrame, keys: list[str], ts: str) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name in keys), T.StructField("origin", df.schema[ts].dataType),
                         T.StructField("horizon_step", T.IntegerType()), T.StructField("method", T.StringType()), T.StructField("forecast", T.DoubleType())])
