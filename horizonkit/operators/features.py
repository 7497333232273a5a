"""Leak-free feature engineering on dense grids.

Lags, rolling statistics and momentum are row-positional (as on a regular
index) and are evaluated in one halo-bucketed window pass, so a long series
is spread over many tasks. Rolling statistics exclude the current row and
require a full window (one missing value in the frame → null).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import all_not_null
from ..functions.timecols import add_steps, day_of, season
from .halo import windowed

LAGS = (1, 6, 24, 168)
ROLLING = (24, 168)
TWO_PI = 2 * math.pi


# ---------------------------------------------------------------- F1, F2
def calendar_cols(ts: str = "ts", prefix: str = "") -> list[Column]:
    t = F.col(ts)
    dow = F.weekday(t)  # Monday = 0
    return [F.hour(t).alias(f"{prefix}hour"), dow.alias(f"{prefix}dayofweek"), F.month(t).alias(f"{prefix}month"),
            F.quarter(t).alias(f"{prefix}quarter"), (dow >= 5).cast("int").alias(f"{prefix}is_weekend"),
            season(t).alias(f"{prefix}season")]


def calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """hour, dayofweek (Mon=0), month, quarter, is_weekend, season."""
    return df.select("*", *calendar_cols(ts))


def cyclical_cols(hour, dow, month, prefix: str = "") -> list[Column]:
    out = []
    for name, c, period in (("hour", hour, 24), ("dayofweek", dow, 7), ("month", month, 12)):
        out.append(F.sin(F.lit(TWO_PI) * c / period).alias(f"{prefix}{name}_sin"))
        out.append(F.cos(F.lit(TWO_PI) * c / period).alias(f"{prefix}{name}_cos"))
    return out


def cyclical(df: DataFrame) -> DataFrame:
    """sin/cos of hour/24, dayofweek/7, month/12 (needs F1 columns)."""
    return df.select("*", *cyclical_cols(F.col("hour"), F.col("dayofweek"), F.col("month")))


# ---------------------------------------------------------------- F3–F5 expressions
def lag_exprs(w, col: str, lags: Sequence[int]) -> list[Column]:
    return [F.lag(col, k).over(w).alias(f"{col}_lag_{k}") for k in lags]


def rolling_exprs(w, col: str, windows: Sequence[int]) -> list[Column]:
    out = []
    for n in windows:
        fr = w.rowsBetween(-n, -1)
        full = F.count(col).over(fr) == n
        out += [F.when(full, F.avg(col).over(fr)).alias(f"{col}_roll_mean_{n}"),
                F.when(full, F.stddev_samp(col).over(fr)).alias(f"{col}_roll_std_{n}"),
                F.when(full, F.min(col).over(fr)).alias(f"{col}_roll_min_{n}"),
                F.when(full, F.max(col).over(fr)).alias(f"{col}_roll_max_{n}")]
    return out


def momentum_exprs(w, col: str) -> list[Column]:
    l1, l2, l25 = F.lag(col, 1).over(w), F.lag(col, 2).over(w), F.lag(col, 25).over(w)
    return [(l1 - l2).alias(f"{col}_diff_1"), (l1 - l25).alias(f"{col}_diff_24"),
            ((l1 - l2) / F.nullif(l2, F.lit(0.0))).alias(f"{col}_pct_change_1"),
            ((l1 - l25) / F.nullif(l25, F.lit(0.0))).alias(f"{col}_pct_change_24")]


def lags(df: DataFrame, col: str = "y", ks: Sequence[int] = LAGS, keys=("series_id",), ts="ts", step="hour",
         bucket_steps=None, bucketed=True) -> DataFrame:
    """F3."""
    return windowed(df, keys, ts, step, max(ks), 0, lambda w: lag_exprs(w, col, ks), bucket_steps, bucketed)


def rolling(df: DataFrame, col: str = "y", ns: Sequence[int] = ROLLING, keys=("series_id",), ts="ts", step="hour",
            bucket_steps=None, bucketed=True) -> DataFrame:
    """F4."""
    return windowed(df, keys, ts, step, max(ns), 0, lambda w: rolling_exprs(w, col, ns), bucket_steps, bucketed)


def momentum(df: DataFrame, col: str = "y", keys=("series_id",), ts="ts", step="hour", bucket_steps=None,
             bucketed=True) -> DataFrame:
    """diffs and pct changes from already-lagged values only."""
    return windowed(df, keys, ts, step, 25, 0, lambda w: momentum_exprs(w, col), bucket_steps, bucketed)


def day_flag(df: DataFrame, days: DataFrame, ts: str = "ts", day_col: str = "day",
             name: str = "is_flagged_anomaly", keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """0/1 by membership of the row's day in a table of flagged days: of its own
    series where the table has the key columns, else of all series."""
    of = [k for k in keys if k in days.columns]
    d = days.select(*of, day_of(day_col).alias("_fday")).distinct().withColumn("_fl", F.lit(1))
    return (df.withColumn("_fday", day_of(ts)).join(d, [*of, "_fday"], "left")
              .withColumn(name, F.coalesce(F.col("_fl"), F.lit(0))).drop("_fday", "_fl"))


def build_features(df: DataFrame, col: str = "y", days: DataFrame | None = None, keys=("series_id",), ts="ts",
                   step="hour", lag_ks: Sequence[int] = LAGS, windows: Sequence[int] = ROLLING,
                   bucket_steps=None, bucketed=True) -> DataFrame:
    """F1→F6 in one projection; every window expression shares one shuffle."""
    x = calendar(df, ts)
    x = cyclical(x)
    before = max(max(lag_ks), max(windows), 25)
    x = windowed(x, keys, ts, step, before, 0,
                 lambda w: lag_exprs(w, col, lag_ks) + rolling_exprs(w, col, windows) + momentum_exprs(w, col),
                 bucket_steps, bucketed)
    if days is not None:
        x = day_flag(x, days, ts, keys=keys)
    else:
        x = x.withColumn("is_flagged_anomaly", F.lit(0))
    return x


# ---------------------------------------------------------------- F8–F9
def supervised(features: DataFrame, horizons: Sequence[int], col: str = "y", keys=("series_id",), ts="ts",
               step="hour", bucket_steps=None, bucketed=True) -> DataFrame:
    """F8: long supervised frame — one row per (row, horizon h): label
    ``y_target = lead(y, h)`` and seven calendar columns of the *target* time."""
    hs = sorted(set(int(h) for h in horizons))
    x = windowed(features, keys, ts, step, 0, max(hs),
                 lambda w: [F.lead(col, h).over(w).alias(f"_lead_{h}") for h in hs], bucket_steps, bucketed)
    pairs = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"_lead_{h}").alias("y_target")) for h in hs])
    x = x.select(*features.columns, F.inline(pairs)).withColumn("_tts", add_steps(ts, F.col("horizon"), step))
    t = F.col("_tts")
    dow = F.weekday(t)
    tgt = cyclical_cols(F.hour(t), dow, F.month(t), prefix="target_") + \
        [(dow >= 5).cast("int").alias("target_is_weekend")]
    return x.select(*features.columns, "horizon", *tgt, "y_target")


def train_mask(sup: DataFrame, train_end, feature_cols: Sequence[str], ts="ts", step="hour") -> DataFrame:
    """rows whose target lies at or before ``train_end`` with label and all features present."""
    end = F.lit(train_end).cast("timestamp_ntz") if not isinstance(train_end, Column) else train_end
    ok = (F.col(ts) <= add_steps(end, -F.col("horizon"), step)) & F.col("y_target").isNotNull() \
        & all_not_null(feature_cols)
    return sup.where(ok)


# ---------------------------------------------------------------- F10–F13
def windows(df: DataFrame, lookback: int, horizon: int, feature_cols: Sequence[str], target_col: str = "y",
            origins: DataFrame | None = None, keys=("series_id",), ts="ts", step="hour", bucket_steps=None,
            bucketed=True) -> DataFrame:
    """look-back window X over ``[t-L+1, t]`` (array of feature arrays)
    and target window Y over ``[t+1, t+H]``; windows touching a null or
    leaving the series are dropped; optional origin list (semi join)."""
    keys = list(keys)
    row = F.when(all_not_null(feature_cols), F.array(*[F.col(c).cast("double") for c in feature_cols]))

    def mk(w):
        return [F.collect_list(row).over(w.rowsBetween(-(lookback - 1), 0)).alias("x_window"),
                F.collect_list(F.col(target_col)).over(w.rowsBetween(1, horizon)).alias("y_window")]

    cols = list(dict.fromkeys([*feature_cols, target_col]))
    x = windowed(df.select(*keys, ts, *cols), keys, ts, step, lookback - 1, horizon, mk, bucket_steps, bucketed)
    x = x.where((F.size("x_window") == lookback) & (F.size("y_window") == horizon)) \
         .select(*keys, F.col(ts).alias("origin"), "x_window", "y_window")
    if origins is not None:
        x = x.join(origins.select(*keys, "origin"), [*keys, "origin"], "left_semi")
    return x


def fit_scaler(df: DataFrame, col: str = "y", keys=("series_id",)) -> DataFrame:
    """F11 fit: mean and sample std of the (training) target, nulls ignored."""
    return df.groupBy(*keys).agg(F.avg(col).alias("scale_mean"), F.stddev_samp(col).alias("scale_std"))


def scale(df: DataFrame, scaler: DataFrame, cols: Sequence[str], keys=("series_id",), inverse=False) -> DataFrame:
    """F11 transform / inverse_transform."""
    x = df.join(scaler, list(keys))
    m, s = F.col("scale_mean"), F.col("scale_std")
    rep = {c: (F.col(c) * s + m) if inverse else (F.col(c) - m) / s for c in cols}
    return x.select(*[rep.get(c, F.col(c)).alias(c) for c in df.columns])


def scale_windows(win: DataFrame, scaler: DataFrame, target_channel: int = 0, keys=("series_id",)) -> DataFrame:
    """standardise only the target channel of X, and all of Y."""
    x = win.join(scaler, list(keys))
    m, s = F.col("scale_mean"), F.col("scale_std")
    xw = F.transform("x_window", lambda r: F.transform(
        r, lambda v, i: F.when(i == target_channel, (v - m) / s).otherwise(v)))
    yw = F.transform("y_window", lambda v: (v - m) / s)
    return x.select(*[c for c in win.columns if c not in ("x_window", "y_window")],
                    xw.alias("x_window"), yw.alias("y_window"))


def standardize(df: DataFrame, cols: Sequence[str], keys=("series_id",)) -> DataFrame:
    """multivariate z-scores with population std (ddof=0), per series."""
    keys = list(keys)
    st = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                               *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    x = df.join(st, keys)
    return x.select(*[((F.col(c) - F.col(f"_m_{c}")) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0))).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


#: Q2: columns of the feature table that are no model inputs (the value itself, and
#: calendar numbers that their sines and cosines stand for).
FEATURE_EXCLUDE = ("y", "hour", "dayofweek", "month", "season")


def model_columns(features: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts", exclude: Sequence[str] = FEATURE_EXCLUDE) -> list[str]:
    """Q2: every numeric column that is no key, no time and not excluded, in order."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [c for c, t in features.dtypes if t in numeric and c not in {*keys, ts, *exclude}]
