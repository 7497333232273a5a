"""Exploratory time-series statistics.

Whole-series quantities (means, sums of lagged products) are partial
aggregates joined back by series key; bounded lags and moving averages use
halo windows. Small per-series results (autocorrelations, regression normal
equations) are finished in grouped pandas functions over those small tables.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distributions import chi2_pvalue_udf
from ..functions.timecols import steps_between
from .grid import series_bounds
from .halo import windowed


# ---------------------------------------------------------------- E1 (classical), E4
def moving_average_trend(w, col: str, period: int):
    """Centred moving average; 2×p average for even periods. Full window required."""
    half = period // 2
    if period % 2:
        fr = w.rowsBetween(-half, half)
        return F.when(F.count(col).over(fr) == period, F.avg(col).over(fr))
    fr = w.rowsBetween(-half, half)
    tot = F.sum(col).over(fr) - 0.5 * (F.lag(col, half).over(w) + F.lead(col, half).over(w))
    return F.when(F.count(col).over(fr) == period + 1, tot / period)


def decompose(df: DataFrame, col: str = "y", period: int = 7, keys=("series_id",), ts="ts", step="day",
              bucket_steps=None, bucketed=True) -> DataFrame:
    """E1 classical additive decomposition: trend = centred moving average,
    seasonal = mean detrended value per phase (position mod period, from the
    series start) centred to sum zero, resid = y - trend - seasonal."""
    keys = list(keys)
    half = period // 2
    x = windowed(df, keys, ts, step, half, half, lambda w: [moving_average_trend(w, col, period).alias("trend")],
                 bucket_steps, bucketed)
    b = series_bounds(df, keys, ts).select(*keys, F.col("_lo"))
    x = x.join(b, keys).withColumn("phase", F.pmod(steps_between("_lo", ts, step), F.lit(period)).cast("int")).drop("_lo")
    ph = x.groupBy(*keys, "phase").agg(F.avg(F.col(col) - F.col("trend")).alias("_pm"))
    ph = ph.join(ph.groupBy(*keys).agg(F.avg("_pm").alias("_pmm")), keys) \
           .select(*keys, "phase", (F.col("_pm") - F.col("_pmm")).alias("seasonal"))
    x = x.join(ph, [*keys, "phase"], "left")
    return x.withColumn("resid", F.col(col) - F.col("trend") - F.col("seasonal"))


def difference(df: DataFrame, col: str = "y", keys=("series_id",), ts="ts", step="day", bucket_steps=None,
               bucketed=True) -> DataFrame:
    """First difference, first row dropped."""
    x = windowed(df, keys, ts, step, 1, 0, lambda w: [(F.col(col) - F.lag(col, 1).over(w)).alias(f"{col}_diff")],
                 bucket_steps, bucketed)
    return x.where(F.col(f"{col}_diff").isNotNull())


# ---------------------------------------------------------------- E2, E6
def acf(df: DataFrame, col: str = "y", nlags: int = 60, keys=("series_id",), ts="ts", step="day",
        bucket_steps=None, bucketed=True) -> DataFrame:
    """Biased autocorrelation r_k = Σ (y_t-ȳ)(y_{t-k}-ȳ) / Σ (y_t-ȳ)² for k = 0..nlags."""
    keys = list(keys)
    m = df.groupBy(*keys).agg(F.avg(col).alias("_m"))
    x = df.join(m, keys).withColumn("_d", F.col(col) - F.col("_m"))
    x = windowed(x, keys, ts, step, nlags, 0,
                 lambda w: [(F.col("_d") * F.lag("_d", k).over(w)).alias(f"_p{k}") for k in range(1, nlags + 1)],
                 bucket_steps, bucketed)
    s = x.groupBy(*keys).agg(F.sum(F.col("_d") * F.col("_d")).alias("_p0"),
                             *[F.sum(f"_p{k}").alias(f"_p{k}") for k in range(1, nlags + 1)],
                             F.count("_d").alias("n"))
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col(f"_p{k}") / F.nullif(F.col("_p0"), F.lit(0.0))).alias("acf"))
                     for k in range(0, nlags + 1)])
    return s.select(*keys, "n", F.inline(rows))


def ljung_box(acf_df: DataFrame, lags: Sequence[int] = (24, 48), keys=("series_id",)) -> DataFrame:
    """Q = n(n+2) Σ_{k<=K} r_k²/(n-k) with a chi-square(K) p-value."""
    keys = list(keys)
    a = acf_df.where(F.col("lag") >= 1)
    aggs = [F.sum(F.when(F.col("lag") <= K, F.col("acf") * F.col("acf") / F.nullif(F.col("n") - F.col("lag"), F.lit(0))))
            .alias(f"_s{K}") for K in lags]
    s = a.groupBy(*keys, "n").agg(*aggs)
    rows = F.array(*[F.struct(F.lit(K).alias("lag"), (F.col("n") * (F.col("n") + 2) * F.col(f"_s{K}")).alias("lb_stat"))
                     for K in lags])
    out = s.select(*keys, F.inline(rows))
    return out.withColumn("lb_pvalue", chi2_pvalue_udf(F.col("lb_stat"), F.col("lag").cast("double")))


def moments(df: DataFrame, col: str = "resid", keys=("series_id",)) -> DataFrame:
    """Population skewness and (non-excess) kurtosis."""
    return df.groupBy(*keys).agg(F.skewness(col).alias("skew"), (F.kurtosis(col) + 3).alias("kurtosis"),
                                 F.count(col).alias("n"))


# ---------------------------------------------------------------- E3 (grouped, tiny input)
def pacf(acf_df: DataFrame, keys=("series_id",)) -> DataFrame:
    """Partial autocorrelation by Levinson–Durbin on each series' ACF
    (nlags+1 rows per series)."""
    keys = list(keys)

    def ld(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = pdf["acf"].to_numpy(dtype="float64")
        K = len(r) - 1
        out = np.full(K + 1, np.nan)
        out[0] = 1.0
        phi = np.zeros(K + 1)
        v = r[0] if K >= 0 else np.nan
        for k in range(1, K + 1):
            if not np.isfinite(v) or v == 0:
                break
            a = (r[k] - np.dot(phi[1:k], r[1:k][::-1])) / v
            new = phi.copy()
            new[k] = a
            new[1:k] = phi[1:k] - a * phi[1:k][::-1]
            phi = new
            v = v * (1 - a * a)
            out[k] = a
        res = pdf[keys].iloc[:1].reindex(range(K + 1)).ffill().reset_index(drop=True) if len(pdf) else pdf[keys]
        res = res.assign(lag=np.arange(K + 1, dtype="int32"), pacf=out)
        return res

    schema = ", ".join(f"{k} string" for k in keys) + ", lag int, pacf double"
    return acf_df.select(*keys, "lag", "acf").groupBy(*keys).applyInPandas(ld, schema)
