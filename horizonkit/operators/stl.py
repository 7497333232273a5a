"""Robust seasonal-trend decomposition by local regression (E1, the STL form).

The published procedure (Cleveland, Cleveland, McRae and Terpenning, 1990): an inner loop
smooths each phase of the period over the years (cycle-subseries), takes the low-pass part
out, and smooths what is left as the trend; an outer loop gives large residuals less
weight (bisquare of six median absolute residuals) and repeats it.

Every smoother is local, so one outer round of a stretch needs a bounded margin of its
neighbours only. A series is dealt into buckets of positions with that halo, each bucket's
round is done in one task on arrays, and only the median of the residuals joins the
buckets of a series between rounds. A series that fits one bucket has no neighbours and
does all its rounds in it. Both ways give the same numbers."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import exact_quantiles
from ..functions.timecols import steps_between
from ..session import materialize
from .grid import series_bounds

BUCKET_STEPS = 32_768
_CHUNK = 1 << 20


def _odd(x: float) -> int:
    """Smallest odd whole number that is at least x."""
    n = int(np.ceil(x))
    return n if n % 2 else n + 1


@dataclass(frozen=True)
class Spans:
    """Lengths of the smoothers (odd numbers of points) and numbers of rounds."""

    period: int
    seasonal: int = 7
    trend: int = 0
    low_pass: int = 0
    inner: int = 2
    outer: int = 15

    @classmethod
    def of(cls, period: int, seasonal: int = 7, trend: int | None = None, low_pass: int | None = None, robust: bool = True,
           inner: int | None = None, outer: int | None = None) -> "Spans":
        if period < 2 or seasonal < 3 or not seasonal % 2:
            raise ValueError("a period has at least 2 steps, the seasonal span is odd and at least 3")
        trend = trend or _odd(1.5 * period / (1 - 1.5 / seasonal))
        low_pass = low_pass or _odd(period + 1)
        if not trend % 2 or not low_pass % 2:
            raise ValueError("spans are odd")
        return cls(period, seasonal, trend, low_pass, inner or (2 if robust else 5), (15 if robust else 0) if outer is None else outer)

    def halo(self) -> int:
        """Steps to either side that one outer round of a row depends on."""
        return self.inner * (self.trend + self.low_pass + self.period + 1 + (self.seasonal + 1) * self.period)


def _local_fit(values, weights, place, at, left, width, span: int, count):
    """Locally linear fit at abscissae ``at``: the points left, left + 1, ... (``width``
    of them) lie at ``place(abscissa, row)`` in ``values``. ``count``: points in all.
    NaN where no point has weight."""
    out = np.empty(len(at))
    most = int(width.max(initial=1))
    for i in range(0, len(at), max(1, _CHUNK // most)):
        rows = slice(i, i + max(1, _CHUNK // most))
        x, lo, m, n = at[rows], left[rows], width[rows], count[rows]
        j = lo[:, None] + np.arange(most)
        inside = np.arange(most) < m[:, None]
        p = np.where(inside, place(j, rows), 0)
        h = np.maximum(x - lo, lo + m - 1 - x) + np.where(span > n, (span - n) // 2, 0)
        r = np.abs(j - x[:, None])
        w = np.where(r <= 0.001 * h[:, None], 1.0, (1 - (r / np.maximum(h, 1e-300)[:, None]) ** 3) ** 3)
        w = np.where(inside & (r <= 0.999 * h[:, None]), w, 0.0) * weights[p]
        total = w.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            w /= total[:, None]
            mean = (w * j).sum(axis=1)
            away = j - mean[:, None]
            spread = (w * away ** 2).sum(axis=1)
            slope = np.where((h > 0) & (np.sqrt(spread) > 0.001 * (n - 1)), (x - mean) / spread, 0.0)
            fit = (w * (1 + slope[:, None] * away) * values[p]).sum(axis=1)
        out[rows] = np.where(total > 0, fit, np.nan)
    return out


def _smooth(values, weights, first: int, size: int, span: int):
    """Local regression over positions first, first + 1, ... of a series of ``size``."""
    t = first + np.arange(len(values))
    m = min(span, size, len(values))
    left = np.clip(t - (min(span, size) - 1) // 2 if span < size else np.zeros_like(t), first, first + len(values) - m)
    fit = _local_fit(values, weights, lambda j, _: j - first, t, left, np.full(len(t), m), span, np.full(len(t), size))
    return np.where(np.isnan(fit), values, fit)


def _seasonal(values, weights, first: int, size: int, s: Spans):
    """Cycle-subseries smoothed, for positions first - period to the end + period."""
    p, n = s.period, len(values)
    t = first + np.arange(n)
    phase, k = t % p, t // p
    count = (size - 1 - phase) // p + 1
    low = (first - phase + p - 1) // p  # least and largest cycle of the phase that is here
    high = (first + n - 1 - phase) // p

    def fit(at, rows, low, high, count, phase):
        m = np.minimum(np.minimum(s.seasonal, count), high - low + 1)
        left = np.clip(at - (s.seasonal - 1) // 2, low, np.maximum(low, high - m + 1))
        return _local_fit(values, weights, lambda j, r: j * p + phase[r, None] - first, at, left, m, s.seasonal, count)

    inside = fit(k, t, low, high, count, phase)
    inside = np.where(np.isnan(inside), values, inside)
    out = np.empty(n + 2 * p)
    out[p:n + p] = inside
    for edge, near, step in ((t[:p], 0, -1), (t[-p:], n - p, 1)):  # the cycle before and after
        ph = edge % p
        beyond = fit(edge // p + step, edge, (first - ph + p - 1) // p, (first + n - 1 - ph) // p, (size - 1 - ph) // p + 1, ph)
        beyond = np.where(np.isnan(beyond), inside[near:near + len(edge)], beyond)
        start = near + p + step * p
        out[start:start + len(edge)] = beyond
    return out


def _average(values, span: int):
    run = np.concatenate([[0.0], np.cumsum(values)])
    return (run[span:] - run[:-span]) / span


def _inner(y, known, weights, trend, first: int, size: int, s: Spans):
    """(trend, seasonal) after the inner rounds, for a stretch that starts at ``first``."""
    w = weights * known
    for _ in range(s.inner):
        cycle = _seasonal(np.where(known > 0, y - trend, 0.0), w, first, size, s)
        low = _average(_average(_average(cycle, s.period), s.period), 3)
        seasonal = cycle[s.period:-s.period] - _smooth(low, np.ones(len(y)), first, size, s.low_pass)
        trend = _smooth(np.where(known > 0, y - seasonal, trend), w, first, size, s.trend)
    return trend, seasonal


def bisquare(residual, six_medians):
    """Robustness weight of absolute residuals."""
    with np.errstate(divide="ignore", invalid="ignore"):
        w = (1 - (residual / six_medians) ** 2) ** 2
    return np.where(residual <= 0.001 * six_medians, 1.0, np.where(residual <= 0.999 * six_medians, w, 0.0))


def stl(df: DataFrame, col: str = "y", period: int = 7, keys: Sequence[str] = ("series_id",), ts: str = "ts", step="day", seasonal: int = 7,
        trend: int | None = None, low_pass: int | None = None, robust: bool = True, inner: int | None = None, outer: int | None = None,
        bucket_steps: int | None = None) -> DataFrame:
    """E1 (STL): ``df`` with columns ``trend``, ``seasonal``, ``resid`` and ``weight`` (the
    robustness weight of the last round), one row per step on a regular grid.

    A null or missing step has no weight in any fit and a null ``resid``. A series needs
    two periods of steps; a shorter one, like one without any value, gets null columns."""
    keys = list(keys)
    s = Spans.of(period, seasonal, trend, low_pass, robust, inner, outer)
    halo = s.halo()
    bucket = bucket_steps or max(BUCKET_STEPS, 8 * halo)
    if halo > bucket:
        raise ValueError("bucket must be at least as long as the halo")
    ends = series_bounds(df, keys, ts).select(*keys, "_lo", (steps_between("_lo", "_hi", step) + 1).alias("_n"))
    base = df.join(ends, keys).withColumn("_p", steps_between("_lo", ts, step))
    rows = materialize(base.select(*keys, F.col("_p").alias("pos"), F.col("_n").alias("size"), F.col(col).cast("double").alias("y")))
    state = rows.select("*", F.lit(0.0).alias("trend"), F.lit(None).cast("double").alias("seasonal"), F.lit(1.0).alias("weight"))
    whole = _rounds(state.where(F.col("size") <= bucket).withColumn("b", F.lit(0).cast("long")), keys, s, s.outer, bucket, 0)
    long = rows.where(F.col("size") > bucket)
    if long.limit(1).count():
        state = state.where(F.col("size") > bucket)
        about = F.lit(halo)
        for k in range(s.outer + 1):
            dealt = state.withColumn("b", F.explode(F.sequence(F.floor(F.greatest(F.col("pos") - about, F.lit(0)) / bucket),
                                                               F.floor(F.least(F.col("pos") + about, F.col("size") - 1) / bucket))))
            state = materialize(_rounds(dealt, keys, s, 0, bucket, halo))
            if k < s.outer:
                off = F.abs(F.col("y") - F.col("trend") - F.col("seasonal"))
                away = state.withColumn("off", off)
                mid = exact_quantiles(away, keys, "off", [0.5], names=["c"]).withColumn("c", 6 * F.col("c"))
                ratio = F.col("off") / F.nullif(F.col("c"), F.lit(0.0))
                w = (F.when(F.col("off") <= 0.001 * F.col("c"), 1.0)
                     .when(F.col("off") <= 0.999 * F.col("c"), F.pow(1 - ratio * ratio, F.lit(2.0))).when(F.col("off").isNotNull(), 0.0))
                state = away.join(mid, keys, "left").withColumn("weight", F.coalesce(w, "weight")).select(*whole.columns)
        whole = whole.unionByName(state)
    out = whole.select(*keys, F.col("pos").alias("_p"), "trend", "seasonal", "weight")
    rest = [c for c in df.columns]
    joined = base.select(*rest, "_p").join(out, [*keys, "_p"], "left")
    return joined.select(*rest, "trend", "seasonal", (F.col(col) - F.col("trend") - F.col("seasonal")).alias("resid"), "weight")


def _rounds(dealt: DataFrame, keys: list[str], s: Spans, outer: int, bucket: int, halo: int) -> DataFrame:
    """One inner loop, and ``outer`` more with new weights, on each bucket of ``dealt``
    (keys, pos, size, y, trend, seasonal, weight, b); its own rows come back."""
    fields = [T.StructField(f.name, f.dataType) for f in dealt.schema.fields if f.name != "b"]

    def fn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("pos").sort_values("pos")
        b, size = int(part["b"].iloc[0]), int(part["size"].iloc[0])
        first, end = max(0, b * bucket - halo), min(size, (b + 1) * bucket + halo)
        here = part["pos"].to_numpy() - first

        def spread(name, fill):
            full = np.full(end - first, fill)
            full[here] = part[name].to_numpy(float)
            return full

        y = spread("y", np.nan)
        known = np.isfinite(y).astype(float)
        if size < 2 * s.period or not known.any():
            part["trend"] = part["seasonal"] = part["weight"] = np.nan
        else:
            y, weights, trend = np.where(known > 0, y, 0.0), spread("weight", 1.0), spread("trend", 0.0)
            trend, seasonal = _inner(y, known, weights, np.zeros(len(y)) if halo == 0 else trend, first, size, s)
            for _ in range(outer):
                off = np.abs(y - trend - seasonal)
                weights = np.where(known > 0, bisquare(off, 6 * np.median(off[known > 0])), weights)
                trend, seasonal = _inner(y, known, weights, trend, first, size, s)
            part["trend"], part["seasonal"], part["weight"] = trend[here], seasonal[here], weights[here]
        own = part["pos"].to_numpy() // bucket == b
        return part.loc[own, [f.name for f in fields]]

    return dealt.groupBy(*keys, "b").applyInPandas(fn, T.StructType(fields))
