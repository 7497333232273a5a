"""Splits, forecast origins, lookup baselines and rolling-origin backtests.

Backtest layout: ``keys..., origin, horizon_step INT, method, actual, forecast``.

Baselines are pure lookups on a dense grid, so a backtest is: a generated
``(origin, step)`` table, one join with the grid for forecast values and one
for actuals. No per-origin loop, no per-series task.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import add_steps, day_of, step_seconds
from .grid import series_bounds
from .halo import carry

BACKTEST_COLS = ["origin", "horizon_step", "method", "actual", "forecast"]


# ---------------------------------------------------------------- B1–B3
def split_point(grid: DataFrame, test_frac: float = 0.2, keys: Sequence[str] = ("series_id",), ts: str = "ts",
                step="hour") -> DataFrame:
    """B1: per series, row ``floor(n * (1 - test_frac))`` (0-based) floored to midnight.

    On a dense grid the k-th row is ``min + k·step``, so only the series bounds
    are needed (a partial aggregate, no ordering of rows).
    """
    keys = list(keys)
    st = step_seconds(step)
    b = series_bounds(grid, keys, ts)
    n = F.timestamp_diff("SECOND", F.col("_lo"), F.col("_hi")) / F.lit(st) + 1
    idx = F.floor(n * F.lit(1.0 - test_frac)).cast("long")
    return b.select(*keys, day_of(add_steps("_lo", idx, step)).alias("test_start"),
                    F.col("_lo").alias("series_start"), F.col("_hi").alias("series_end"))


def chrono_split(df: DataFrame, frac: float, keys: Sequence[str] = ("series_id",), ts: str = "ts",
                 step="hour", drop_null_cols: Sequence[str] | None = None) -> DataFrame:
    """B2: time-ordered fraction split after an optional null drop; the first
    ``floor(n·frac)`` rows of each series are ``train``, the rest ``test``.
    Row positions come from the two-phase carry (no whole-series task)."""
    keys = list(keys)
    if drop_null_cols:
        df = df.na.drop(subset=list(drop_null_cols))
    x = carry(df, keys, ts, step, [], prev=False, nxt=False, position=True)
    n = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    x = x.join(n, keys)
    cut = F.floor(F.col("_n") * F.lit(float(frac)))
    return x.select(*df.columns, F.when(F.col("_pos") <= cut, "train").otherwise("test").alias("split"))


def forecast_origins(split: DataFrame, horizon: int = 24, every_steps: int = 24, keys: Sequence[str] = ("series_id",),
                     step="hour") -> DataFrame:
    """Origins from ``test_start`` to ``series_end - horizon`` inclusive, every ``every_steps``."""
    keys = list(keys)
    last = add_steps("series_end", -horizon, step)
    n = F.floor(F.timestamp_diff("SECOND", F.col("test_start"), last) / F.lit(step_seconds(step) * every_steps))
    k = F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long")))
    return (split.where(F.col("test_start") <= last)
                 .select(*keys, "test_start", k.alias("_k"))
                 .select(*keys, add_steps("test_start", F.col("_k") * every_steps, step).alias("origin")))


# ---------------------------------------------------------------- lookup methods
@dataclass(frozen=True)
class LookupMethod:
    """A forecaster whose value for step ``h`` is the grid value at
    ``origin + offset(h)`` steps. ``lo/hi`` bound the offsets over 1..H; an
    origin whose look-up window leaves the series is skipped as a whole."""
    name: str
    offset: Callable[[Column], Column]
    lo: Callable[[int], int]
    hi: Callable[[int], int]
    max_horizon: int | None = None


def naive(name: str = "naive") -> LookupMethod:
    """The value at the origin for every step."""
    return LookupMethod(name, lambda h: F.lit(0), lambda H: 0, lambda H: 0)


def seasonal_naive(lag: int, name: str | None = None) -> LookupMethod:
    """Value ``lag`` steps before each target; refuses horizons beyond the lag."""
    return LookupMethod(name or f"seasonal_naive_{lag}", lambda h: h - lag, lambda H: 1 - lag,
                        lambda H: H - lag, max_horizon=lag)


def daily_seasonal_naive(name: str = "daily_naive") -> LookupMethod:
    """B6 (hourly grid)."""
    return seasonal_naive(24, name)


def weekly_seasonal_naive(name: str = "weekly_naive") -> LookupMethod:
    """B7 (hourly grid)."""
    return seasonal_naive(168, name)


def tiled_profile(period: int = 24, name: str = "daily_profile") -> LookupMethod:
    """The last ``period`` values ending at the origin, tiled forward.
    Valid at any horizon; equals B6 for ``h <= period``."""
    return LookupMethod(name, lambda h: F.pmod(h - 1, F.lit(period)) - (period - 1),
                        lambda H: -(period - 1), lambda H: 0)


def lookup_forecasts(grid: DataFrame, origins: DataFrame, methods: Sequence[LookupMethod], horizon: int,
                     keys: Sequence[str] = ("series_id",), ts: str = "ts", y: str = "y", step="hour") -> DataFrame:
    """Forecast rows ``keys, origin, horizon_step, method, forecast`` for lookup methods."""
    keys = list(keys)
    for m in methods:
        if m.max_horizon is not None and horizon > m.max_horizon:
            raise ValueError(f"{m.name} can forecast at most {m.max_horizon} steps, {horizon} asked for")
    o = origins.select(*keys, "origin").join(series_bounds(grid, keys, ts), keys)
    parts = []
    for m in methods:
        ok = ((add_steps("origin", m.lo(horizon), step) >= F.col("_lo"))
              & (add_steps("origin", m.hi(horizon), step) <= F.col("_hi")))
        r = (o.where(ok)
              .select(*keys, "origin", F.lit(m.name).alias("method"),
                      F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon_step")))
        parts.append(r.withColumn("_lookup", add_steps("origin", m.offset(F.col("horizon_step")), step)))
    look = parts[0]
    for p in parts[1:]:
        look = look.unionByName(p)
    g = grid.select(*keys, F.col(ts).alias("_lookup"), F.col(y).alias("forecast"))
    return look.join(g, [*keys, "_lookup"], "left").drop("_lookup")


def attach_actuals(forecasts: DataFrame, grid: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts",
                   y: str = "y", step="hour") -> DataFrame:
    """Actual at ``origin + horizon_step`` (null when off the grid)."""
    keys = list(keys)
    f = forecasts.withColumn("_target", add_steps("origin", F.col("horizon_step"), step))
    g = grid.select(*keys, F.col(ts).alias("_target"), F.col(y).alias("actual"))
    return (f.join(g, [*keys, "_target"], "left")
             .select(*keys, "origin", F.col("horizon_step").cast("int").alias("horizon_step"), "method",
                     "actual", "forecast"))


def run_backtest(grid: DataFrame, origins: DataFrame, methods: Sequence, horizon: int = 24,
                 keys: Sequence[str] = ("series_id",), ts: str = "ts", y: str = "y", step="hour") -> DataFrame:
    """Every method at every origin; one row per (origin, step, method).

    ``methods`` holds ``LookupMethod`` specs and/or callables
    ``fn(grid, origins, horizon) -> keys, origin, horizon_step, method, forecast``
    (the pluggable forecaster contract).
    """
    keys = list(keys)
    lookups = [m for m in methods if isinstance(m, LookupMethod)]
    others = [m for m in methods if not isinstance(m, LookupMethod)]
    parts = []
    if lookups:
        parts.append(lookup_forecasts(grid, origins, lookups, horizon, keys, ts, y, step))
    for fn in others:
        parts.append(fn(grid, origins, horizon).select(*keys, "origin", "horizon_step", "method", "forecast"))
    fc = parts[0]
    for p in parts[1:]:
        fc = fc.unionByName(p)
    return attach_actuals(fc, grid, keys, ts, y, step)


def from_continuous(forecast: DataFrame, actual: DataFrame, origins: DataFrame, horizon: int, method: str,
                    keys: Sequence[str] = ("series_id",), ts: str = "ts", forecast_col: str = "forecast",
                    y: str = "y", step="hour") -> DataFrame:
    """Slice one continuous forecast into backtest rows; missing
    timestamps on either side give nulls, rows are kept."""
    keys = list(keys)
    r = (origins.select(*keys, "origin", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon_step"))
                .withColumn("method", F.lit(method)))
    r = r.withColumn("_target", add_steps("origin", F.col("horizon_step"), step))
    f = forecast.select(*keys, F.col(ts).alias("_target"), F.col(forecast_col).alias("forecast"))
    a = actual.select(*keys, F.col(ts).alias("_target"), F.col(y).alias("actual"))
    return (r.join(f, [*keys, "_target"], "left").join(a, [*keys, "_target"], "left")
             .select(*keys, "origin", F.col("horizon_step").cast("int").alias("horizon_step"), "method",
                     "actual", "forecast"))


def coverage(bt: DataFrame, n_origins: DataFrame, horizon: int, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Scored pairs (both sides present) per method against origins × steps."""
    keys = list(keys)
    c = bt.groupBy(*keys, "method").agg(
        F.count_if(F.col("actual").isNotNull() & F.col("forecast").isNotNull()).alias("scored_pairs"),
        F.countDistinct("origin").alias("origins_used"))
    c = c.join(n_origins, keys)
    possible = F.col("n_origins") * F.lit(horizon)
    return c.select(*keys, "method", "scored_pairs", "origins_used", possible.alias("possible_pairs"),
                    (F.col("scored_pairs") * 100.0 / F.nullif(possible, F.lit(0))).alias("coverage_pct"))
