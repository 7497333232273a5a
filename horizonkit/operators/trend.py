"""Trend with chosen changepoints, yearly, weekly and daily terms, and intervals.

The series is a piecewise-linear trend plus Fourier terms of calendar periods. Candidate
changepoints lie evenly over the first part of the history; an absolute-value penalty on
the changes of slope keeps few of them, squared penalties hold the other terms. Sums of
products per series (time buckets in parallel, then added) are all the fit reads: the
terms with squared penalties are eliminated from them exactly, and coordinate descent
runs on the slope changes alone, in turn with the noise variance.

Forecasts need only time: they are column expressions. Their intervals add the noise and
the variance of the slope changes still to come, at the rate and size of those found."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import epoch_seconds

DAY = 86_400.0
#: name: (period in seconds, Fourier order)
SEASONS = {"yearly": (365.25 * DAY, 10), "weekly": (7 * DAY, 3), "daily": (DAY, 4)}
BUCKET_ROWS = 32_768
_ROUNDS, _SWEEPS = 30, 400


@dataclass(frozen=True)
class Design:
    """What a fit's coefficients belong to, in order: 1, time, slope changes, Fourier terms."""

    changepoints: tuple[float, ...]
    seasons: tuple[tuple[str, float, int], ...]

    @classmethod
    def of(cls, n_changepoints: int = 25, history: float = 0.8, seasons: dict | None = None) -> "Design":
        points = tuple(history * (i + 1) / (n_changepoints + 1) for i in range(n_changepoints))
        return cls(points, tuple((k, *v) for k, v in (SEASONS if seasons is None else seasons).items()))

    def width(self) -> int:
        return 2 + len(self.changepoints) + sum(2 * n for _, _, n in self.seasons)

    def array(self, seconds: np.ndarray, start: float, span: float) -> np.ndarray:
        t = (seconds - start) / span
        columns = [np.ones(len(t)), t, *(np.maximum(t - c, 0.0) for c in self.changepoints)]
        for _, period, order in self.seasons:
            angle = 2 * math.pi * (seconds % period) / period
            for k in range(1, order + 1):
                columns += [np.sin(k * angle), np.cos(k * angle)]
        return np.column_stack(columns)

    def terms(self, seconds: Column, start: Column, span: Column) -> dict[str, list[Column]]:
        """The same columns as expressions, by component."""
        t = (seconds - start) / span
        out = {"trend": [F.lit(1.0), t, *(F.greatest(t - F.lit(c), F.lit(0.0)) for c in self.changepoints)]}
        for name, period, order in self.seasons:
            angle = F.lit(2 * math.pi) * (seconds % F.lit(period)) / F.lit(period)
            out[name] = [x for k in range(1, order + 1) for x in (F.sin(k * angle), F.cos(k * angle))]
        return out


def slope_changes(m: np.ndarray, n: int, design: Design, slope_scale: float = 0.05, ridge_scale: float = 10.0) -> tuple[np.ndarray, float]:
    """Coefficients and noise variance from the sums of products ``m`` (terms, then the
    value, scaled to at most 1): the minimum of RSS / (2 s2) + sum |changes| / slope_scale
    + sum of the other terms' squares / (2 ridge_scale ** 2), in turn with s2 = RSS / n."""
    k, c = design.width(), len(design.changepoints)
    hinge, free = np.arange(2, 2 + c), np.r_[0:2, 2 + c:k]
    s2 = max(m[k, k] / n - (m[0, k] / n) ** 2, 1e-12)
    change, beta = np.zeros(c), np.zeros(k)
    for _ in range(_ROUNDS):
        a = m[np.ix_(free, free)] / s2 + np.eye(len(free)) / ridge_scale ** 2
        cross, value = m[np.ix_(free, hinge)] / s2, m[free, k] / s2
        solved = np.linalg.solve(a, np.column_stack([cross, value]))
        q = m[np.ix_(hinge, hinge)] / s2 - cross.T @ solved[:, :-1]
        r = m[hinge, k] / s2 - cross.T @ solved[:, -1]
        for _ in range(_SWEEPS):
            before = change.copy()
            for j in range(c):
                if q[j, j] > 1e-12:
                    pull = r[j] - q[j] @ change + q[j, j] * change[j]
                    change[j] = math.copysign(max(0.0, abs(pull) - 1 / slope_scale), pull) / q[j, j]
            if np.abs(change - before).max(initial=0.0) < 1e-10:
                break
        beta[hinge], beta[free] = change, solved[:, -1] - solved[:, :-1] @ change
        rss = max(0.0, m[k, k] - 2 * beta @ m[:k, k] + beta @ m[:k, :k] @ beta)
        last, s2 = s2, max(rss / n, 1e-12)
        if abs(s2 - last) < 1e-9 * last:
            break
    return beta, s2


def fit_trend(train: DataFrame, col: str = "y", keys: Sequence[str] = ("series_id",), ts: str = "ts", n_changepoints: int = 25, history: float = 0.8,
              seasons: dict | None = None, slope_scale: float = 0.05, ridge_scale: float = 10.0, bucket_seconds: int | None = None) -> tuple[DataFrame, Design]:
    """(keys, coef, changes, sigma, n, start, span) per series and the design of
    ``coef``. ``changes`` are the changes of slope chosen: (at seconds, change per day).

    Null values are left out; steps need not be regular. A series with fewer than three
    values, or all at one time, gets no row."""
    keys = list(keys)
    design = Design.of(n_changepoints, history, seasons)
    k = design.width()
    d = train.where(F.col(col).isNotNull()).select(*keys, epoch_seconds(ts).alias("s"), F.col(col).cast("double").alias("y"))
    of = d.groupBy(*keys).agg(F.min("s").alias("start"), F.max("s").alias("stop"), F.max(F.abs("y")).alias("top"), F.count(F.lit(1)).alias("n"))
    of = of.where("n >= 3 and stop > start").select(*keys, "n", F.col("start").cast("double").alias("start"), (F.col("stop") - F.col("start")).cast("double").alias("span"),
                                                    F.when(F.col("top") > 0, F.col("top")).otherwise(1.0).alias("top"))
    per = F.lit(bucket_seconds) if bucket_seconds else F.greatest(F.lit(1.0), F.col("span") * BUCKET_ROWS / F.col("n"))
    rows = d.join(of, keys).withColumn("b", F.floor((F.col("s") - F.col("start")) / per))
    key_fields = [f for f in train.schema.fields if f.name in keys]
    cell = T.StructType([*key_fields, T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("v", T.DoubleType())])

    def sums(part: pd.DataFrame) -> pd.DataFrame:
        x = design.array(part["s"].to_numpy(float), part["start"].iloc[0], part["span"].iloc[0])
        x = np.column_stack([x, part["y"].to_numpy(float) / part["top"].iloc[0]])
        i, j = np.triu_indices(k + 1)
        frame = pd.DataFrame({"i": i, "j": j, "v": (x.T @ x)[i, j]})
        for name in reversed(keys):
            frame.insert(0, name, part[name].iloc[0])
        return frame

    moments = rows.groupBy(*keys, "b").applyInPandas(sums, cell).groupBy(*keys, "i", "j").agg(F.sum("v").alias("v")).join(of, keys)
    change = T.StructType([T.StructField("at", T.LongType()), T.StructField("per_day", T.DoubleType())])
    schema = T.StructType([*key_fields, T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("changes", T.ArrayType(change)),
                           *(T.StructField(c, t) for c, t in (("sigma", T.DoubleType()), ("n", T.LongType()), ("start", T.DoubleType()), ("span", T.DoubleType())))])

    def solve(cells: pd.DataFrame) -> pd.DataFrame:  # one row per pair of terms
        m = np.zeros((k + 1, k + 1))
        m[cells["i"], cells["j"]] = m[cells["j"], cells["i"]] = cells["v"]
        first = cells.iloc[0]
        beta, s2 = slope_changes(m, int(first["n"]), design, slope_scale, ridge_scale)
        top, start, span = first["top"], first["start"], first["span"]
        found = [{"at": int(round(start + at * span)), "per_day": float(v * top * DAY / span)} for at, v in zip(design.changepoints, beta[2:]) if v]
        return pd.DataFrame([{**{c: first[c] for c in keys}, "coef": (beta * top).tolist(), "changes": found, "sigma": float(np.sqrt(s2) * top),
                              "n": int(first["n"]), "start": start, "span": span}])

    return moments.groupBy(*keys).applyInPandas(solve, schema), design


def forecast_trend(fit: DataFrame, design: Design, future: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts", z: float = 1.2815515655446004) -> DataFrame:
    """(keys, ts, trend, one column per season, seasonal, forecast, lower, upper) at the
    times of ``future``; ``z`` normal deviations to either side (80 % by default). After
    the history the trend's variance grows with the cube of time: slope changes come at
    the rate of candidates, Laplace distributed with the mean size of those in the fit."""
    keys = list(keys)
    x = future.select(*keys, ts).join(fit.select(*keys, "coef", "sigma", "start", "span"), keys)
    seconds, at, parts = epoch_seconds(ts), 1, {}
    for name, terms in design.terms(seconds, F.col("start"), F.col("span")).items():
        parts[name] = sum((F.element_at("coef", at + i) * term for i, term in enumerate(terms)), F.lit(0.0))
        at += len(terms)
    c = len(design.changepoints)
    size = F.aggregate(F.slice("coef", 3, c), F.lit(0.0), lambda a, v: a + F.abs(v)) / max(1, c) if c else F.lit(0.0)
    x = x.select(*keys, ts, *[v.alias(n) for n, v in parts.items()], "sigma", size.alias("_b"),
                 F.greatest((seconds - F.col("start")) / F.col("span") - 1, F.lit(0.0)).alias("_h"))
    seasonal = sum((F.col(n) for n, _, _ in design.seasons), F.lit(0.0))
    rate = c / max(design.changepoints) if c else 0.0
    deviation = F.sqrt(F.col("sigma") * F.col("sigma") + rate * 2 * F.col("_b") * F.col("_b") * F.pow("_h", F.lit(3.0)) / 3)
    x = x.withColumn("seasonal", seasonal).withColumn("forecast", F.col("trend") + F.col("seasonal")).withColumn("_d", z * deviation)
    return x.select(*keys, ts, *parts, "seasonal", "forecast", (F.col("forecast") - F.col("_d")).alias("lower"), (F.col("forecast") + F.col("_d")).alias("upper"))
