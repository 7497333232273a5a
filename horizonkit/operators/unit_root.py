"""Stationarity tests with lags and bandwidths chosen from the data (E5).

Missing values are left out first and the rest numbered, so a lag is a number of
observations, whatever gaps lie between. Rows are dealt into buckets of those numbers
(each with the observations before it that its lags reach into), and each bucket gives
sums of products: no task sees a whole series, and the statistics are the same for any
bucket size.

* ADF (constant): one nested moment matrix over the common sample holds the regressions
  of every lag count up to Schwert's bound; the one of least AIC is solved again with the
  observations its shorter lags gain, and its p-value is MacKinnon's response surface.
* KPSS (level): running sums in two phases, Bartlett long-run variance with the bandwidth
  of Hobijn, Franses and Ooms, p-value between the published critical values."""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distributions import normal_cdf
from ..session import materialize
from .halo import carry

BUCKET_ROWS = 32_768

# Response surface of the ADF p-value (constant, one series), as published
# (MacKinnon 1994): p is the normal distribution function of a polynomial of the
# statistic; one for small p up to TAU_STAR, one for large p.
TAU_MIN, TAU_STAR, TAU_MAX = -18.83, -1.61, 2.74
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)

# Critical values of the KPSS level statistic.
KPSS_P = (0.10, 0.05, 0.025, 0.01)
KPSS_AT = (0.347, 0.463, 0.574, 0.739)


def adf_pvalue(statistic: float) -> float:
    if not np.isfinite(statistic):
        return float("nan")
    if statistic > TAU_MAX:
        return 1.0
    if statistic < TAU_MIN:
        return 0.0
    terms = SMALL_P if statistic <= TAU_STAR else LARGE_P
    return normal_cdf(sum(c * statistic ** k for k, c in enumerate(terms)))


def kpss_pvalue(statistic: Column) -> Column:
    """Straight lines between the critical values; the outer ones bound it."""
    p = F.when(statistic <= KPSS_AT[0], KPSS_P[0])
    for (x, y), (x2, y2) in zip(zip(KPSS_AT, KPSS_P), zip(KPSS_AT[1:], KPSS_P[1:])):
        p = p.when(statistic <= x2, y + (y2 - y) * (statistic - x) / (x2 - x))
    return p.when(statistic > KPSS_AT[-1], KPSS_P[-1])


def longest_lag(n: int) -> int:
    """Schwert's bound, and no more than the sample can carry."""
    return max(0, min(int(np.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2))


def observations(df: DataFrame, col: str, keys: Sequence[str], ts: str, step, bucket_steps: int = 8192) -> DataFrame:
    """(keys, pos, n, e): non-null values numbered from 0 per series, less their mean."""
    keys = list(keys)
    d = df.where(F.col(col).isNotNull()).select(*keys, ts, F.col(col).cast("double").alias("_y"))
    of = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("_mu"))
    placed = carry(d, keys, ts, step, [], bucket_steps).join(of, keys)
    return placed.select(*keys, (F.col("_pos") - 1).alias("pos"), "n", (F.col("_y") - F.col("_mu")).alias("e"))


def _bucketed(obs: DataFrame, reach: int, bucket: int) -> DataFrame:
    """Rows with their bucket ``b`` of positions, and again in the next buckets that reach
    back to them."""
    last = F.floor(F.least(F.col("pos") + reach, F.col("n") - 1) / bucket)
    return obs.withColumn("b", F.explode(F.sequence(F.floor(F.col("pos") / bucket), last)))


def _lagged(e: np.ndarray, lag: int) -> np.ndarray:
    """e shifted by ``lag`` (what lies before the array is NaN)."""
    return np.concatenate([np.full(min(lag, len(e)), np.nan), e[:max(0, len(e) - lag)]])


def _moments(obs: DataFrame, keys: list[str], reach: int, bucket: int) -> DataFrame:
    """(keys, n, kind, i, j, v): sums over all positions of a series. kind 'adf': products
    of the columns 1, level before, difference 1 .. p back, difference, over the common
    sample; 'head': the first values; 'acv': lagged products of lag i; 'run': per bucket j
    sums of its running sums' squares (0), of the running sums (1), rows (2), values (3)."""
    key_fields = [f for f in obs.schema.fields if f.name in keys]
    schema = T.StructType([*key_fields, T.StructField("n", T.LongType()), *(T.StructField(x, t) for x, t in (
        ("kind", T.StringType()), ("i", T.IntegerType()), ("j", T.LongType()), ("v", T.DoubleType())))])

    def fn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        n, b = int(part["n"].iloc[0]), int(part["b"].iloc[0])
        pos, e = part["pos"].to_numpy(), part["e"].to_numpy(float)
        own = pos // bucket == b
        p, out = longest_lag(n), []
        back = _lagged(e, 1)
        change = e - back
        x = np.column_stack([np.ones(len(e)), back, *(_lagged(change, k) for k in range(1, p + 1)), change])
        used = x[own & (pos > p)]
        m = used.T @ used
        out += [("adf", i, j, m[i, j]) for i in range(p + 3) for j in range(i, p + 3)]
        out += [("head", int(q), 0, v) for q, v in zip(pos[own & (pos <= p)], e[own & (pos <= p)])]
        for k in range(0, min(reach, n - 1) + 1):
            pair = e * _lagged(e, k)
            out.append(("acv", k, 0, pair[own & (pos >= k)].sum()))
        run = np.cumsum(e[own])
        out += [("run", i, b, v) for i, v in enumerate((run @ run, run.sum(), len(run), run[-1] if len(run) else 0.0))]
        frame = pd.DataFrame(out, columns=["kind", "i", "j", "v"])
        frame.insert(0, "n", n)
        for k in reversed(keys):
            frame.insert(0, k, part[k].iloc[0])
        return frame

    parts = _bucketed(obs, reach, bucket).groupBy(*keys, "b").applyInPandas(fn, schema)
    return parts.groupBy(*keys, "n", "kind", "i", "j").agg(F.sum("v").alias("v"))


def _adf(cells: pd.DataFrame, n: int) -> dict:
    """Statistic, p-value and lags from a series' sums."""
    p = longest_lag(n)
    none = {"adf_stat": np.nan, "adf_pvalue": np.nan, "adf_lags": None}
    m = np.zeros((p + 3, p + 3))
    for i, j, v in cells.loc[cells["kind"] == "adf", ["i", "j", "v"]].itertuples(index=False):
        m[int(i), int(j)] = m[int(j), int(i)] = v
    head = cells.loc[cells["kind"] == "head"].sort_values("i")["v"].to_numpy()

    def solve(m, k):
        at = [*range(2 + k), len(m) - 1]
        a, c, yy = m[np.ix_(at[:-1], at[:-1])], m[at[:-1], at[-1]], m[at[-1], at[-1]]
        scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
        inverse = np.linalg.inv(a / np.outer(scale, scale)) / np.outer(scale, scale)
        beta = inverse @ c
        rss = max(0.0, yy - c @ beta)
        return beta, rss, inverse

    rows = n - p - 1
    best = None
    try:
        for k in range(p + 1):
            _, rss, _ = solve(m, k)
            if rows <= 2 + k or rss <= 1e-12 * m[-1, -1]:
                return none
            aic = rows * np.log(rss / rows) + 2 * (2 + k)
            if best is None or aic < best[0]:
                best = (aic, k)
        k = best[1]
        x = [[1.0, head[t - 1], *(head[t - i] - head[t - i - 1] for i in range(1, k + 1)), head[t] - head[t - 1]] for t in range(k + 1, p + 1)]
        at = [*range(2 + k), p + 2]
        more = m[np.ix_(at, at)] + (np.array(x).T @ np.array(x) if x else 0.0)
        beta, rss, inverse = solve(more, k)
        stat = float(beta[1] / np.sqrt(rss / (n - k - 1 - 2 - k) * inverse[1, 1]))
    except (np.linalg.LinAlgError, ZeroDivisionError):
        return none
    return {"adf_stat": stat, "adf_pvalue": adf_pvalue(stat), "adf_lags": k} if np.isfinite(stat) else none


def _bandwidths(moments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lags): the KPSS bandwidth of each series."""
    n, reads = F.col("n"), F.floor(F.pow("n", F.lit(2.0 / 9.0)))
    near = (F.col("i") > 0) & (F.col("i") <= reads)
    sums = moments.where("kind = 'acv'").groupBy(*keys, "n").agg(
        F.sum(F.when(F.col("i") == 0, F.col("v") / n).when(near, 2 * F.col("v") / n)).alias("s0"),
        F.sum(F.when(near, 2 * F.col("i") * F.col("v") / n).otherwise(0.0)).alias("s1"))
    ratio = F.col("s1") / F.nullif(F.col("s0"), F.lit(0.0))
    lags = F.floor(1.1447 * F.pow(ratio * ratio, F.lit(1.0 / 3.0)) * F.pow("n", F.lit(1.0 / 3.0)))
    return sums.select(*keys, F.coalesce(F.least(lags, n - 1), F.lit(0)).cast("int").alias("lags"))


def _autocovariances(obs: DataFrame, keys: list[str], reach: int, bucket: int) -> DataFrame:
    """(keys, kind, i, v): lagged products of the lags 1 .. ``lags`` of each series."""
    key_fields = [f for f in obs.schema.fields if f.name in keys]
    schema = T.StructType([*key_fields, T.StructField("i", T.IntegerType()), T.StructField("v", T.DoubleType())])

    def fn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        pos, e = part["pos"].to_numpy(), part["e"].to_numpy(float)
        own = pos // bucket == int(part["b"].iloc[0])
        lags = range(0, int(part["lags"].iloc[0]) + 1)
        frame = pd.DataFrame({"i": list(lags), "v": [(e * _lagged(e, k))[own & (pos >= k)].sum() for k in lags]})
        for k in reversed(keys):
            frame.insert(0, k, part[k].iloc[0])
        return frame

    return _bucketed(obs, reach, bucket).groupBy(*keys, "b").applyInPandas(fn, schema).groupBy(*keys, "i").agg(F.sum("v").alias("v"))


def kpss(obs: DataFrame, moments: DataFrame, keys: list[str], bucket: int) -> DataFrame:
    """(keys, kpss_stat, kpss_lags) of each series of ``observations``."""
    lags = materialize(_bandwidths(moments, keys))
    reach = lags.agg(F.max("lags")).first()[0] or 0
    width = max(bucket, reach + 1)
    again = _autocovariances(obs.join(lags, keys), keys, reach, width).join(lags, keys)
    taper = F.when(F.col("i") == 0, 1.0).otherwise(2 * (1 - F.col("i") / (F.col("lags") + 1)))
    long_run = again.groupBy(*keys, "lags").agg(F.sum(F.col("v") * taper).alias("_s"))
    # running sums: those of a bucket, plus the total of the buckets before it
    run = moments.where("kind = 'run'").groupBy(*keys, "n", "j").pivot("i", [0, 1, 2, 3]).agg(F.first("v"))
    before = F.coalesce(F.sum("3").over(Window.partitionBy(*keys).orderBy("j").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    run = run.withColumn("_o", before)
    eta = run.groupBy(*keys, "n").agg(F.sum(F.col("0") + 2 * F.col("_o") * F.col("1") + F.col("_o") * F.col("_o") * F.col("2")).alias("_ss"))
    stat = F.when(F.col("_s") > 0, F.col("_ss") / (F.col("n") * F.col("_s")))
    return eta.join(long_run, keys).select(*keys, stat.alias("kpss_stat"), F.col("lags").alias("kpss_lags"))


def stationarity(df: DataFrame, col: str = "y", keys: Sequence[str] = ("series_id",), ts: str = "ts", step="day",
                 bucket_rows: int | None = None) -> DataFrame:
    """E5: (keys, n, adf_stat, adf_pvalue, adf_lags, adf_stationary, kpss_stat,
    kpss_pvalue, kpss_lags, kpss_stationary) per series: ADF rejects a unit root at 5 %,
    KPSS does not reject stationarity at 5 %.

    Nulls are left out. A series too short, constant, or explained without error has null
    statistics and verdicts false; a series without values gives no row."""
    keys = list(keys)
    obs = materialize(observations(df, col, keys, ts, step))
    most = obs.agg(F.max("n")).first()[0] or 1
    reach = max(longest_lag(most) + 1, int(most ** (2.0 / 9.0)) + 1)
    bucket = max(bucket_rows, reach + 1) if bucket_rows else max(BUCKET_ROWS, 128 * reach)
    sums = materialize(_moments(obs, keys, reach, bucket))
    level = kpss(obs, sums, keys, bucket)
    key_fields = [f for f in obs.schema.fields if f.name in keys]
    schema = T.StructType([*key_fields, *(T.StructField(x, t) for x, t in (
        ("n", T.LongType()), ("adf_stat", T.DoubleType()), ("adf_pvalue", T.DoubleType()), ("adf_lags", T.IntegerType())))])

    def fn(cells: pd.DataFrame) -> pd.DataFrame:  # one row per pair of regressors, and no more than p values
        n = int(cells["n"].iloc[0])
        found = {**{k: cells[k].iloc[0] for k in keys}, "n": n, **_adf(cells, n)}
        return pd.DataFrame([found], columns=schema.fieldNames()).astype({"adf_lags": "Int32"})

    unit = sums.where("kind in ('adf', 'head')").groupBy(*keys).applyInPandas(fn, schema)
    x = unit.join(level, keys, "left").withColumn("kpss_pvalue", kpss_pvalue(F.col("kpss_stat")))
    for c in ("adf_stat", "adf_pvalue"):
        x = x.withColumn(c, F.when(~F.isnan(c), F.col(c)))
    return x.select(*keys, "n", "adf_stat", "adf_pvalue", "adf_lags", F.coalesce(F.col("adf_pvalue") < 0.05, F.lit(False)).alias("adf_stationary"),
                    "kpss_stat", "kpss_pvalue", "kpss_lags", F.coalesce(F.col("kpss_pvalue") > 0.05, F.lit(False)).alias("kpss_stationary"))
