"""Forecast accuracy tables (M5–M13). All are single native aggregations
(partial + final), never per-group Python."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import metric_aggs
from ..functions.timecols import season


def score(bt: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M5 (``by=()``), M6 (``by=[method]``), M7 (``by=[method, horizon_step]``)."""
    by = list(by)
    return bt.groupBy(*by).agg(*metric_aggs()) if by else bt.agg(*metric_aggs())


def leaderboard(bt: DataFrame, by: Sequence[str] = ("method",)) -> DataFrame:
    """M6: metrics per method with the MAE rank (1 = best)."""
    lb = score(bt, by)
    part = [c for c in by if c != "method"]
    w = Window.partitionBy(*part).orderBy(F.col("MAE").asc_nulls_last(), F.col("method")) if part else \
        Window.orderBy(F.col("MAE").asc_nulls_last(), F.col("method"))
    return lb.withColumn("mae_rank", F.rank().over(w))


def by_step(bt: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """M7."""
    return score(bt, [*extra, "method", "horizon_step"])


def by_fold(bt: DataFrame, folds: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """M8: metrics per (method, fold); rows whose origin has no fold are dropped."""
    return score(bt.join(folds.select("origin", "fold"), "origin", "inner"), [*extra, "method", "fold"])


def by_season(bt: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """M9: metrics per (method, season of the origin)."""
    return score(bt.withColumn("season", season("origin")), [*extra, "method", "season"])


def pivot_metric(df: DataFrame, row: str, col: str, metric: str = "MAE", values: Sequence | None = None) -> DataFrame:
    """Fold × method / season × method matrices (the pivoted M8/M9 views)."""
    g = df.groupBy(row)
    g = g.pivot(col, list(values)) if values is not None else g.pivot(col)
    return g.agg(F.first(metric))


def horizon_exact(bt: DataFrame, steps: Sequence[int] = (1, 24, 168), by: Sequence[str] = ("method",)) -> DataFrame:
    """MAE at exactly step k (null when the step is absent)."""
    err = F.abs(F.col("actual") - F.col("forecast"))
    aggs = [F.avg(F.when(F.col("horizon_step") == k, err)).alias(f"mae_h{k}") for k in steps]
    return bt.where(F.col("actual").isNotNull() & F.col("forecast").isNotNull()).groupBy(*by).agg(*aggs)


def horizon_avg(bt_short: DataFrame, bt_long: DataFrame, by: Sequence[str] = ("method",)) -> DataFrame:
    """Averaged variant — '1h' = step 1 and '24h' = all steps of the short
    backtest, '7d' = all steps of the long one. Differs from M10 on purpose."""
    by = list(by)
    ok = F.col("actual").isNotNull() & F.col("forecast").isNotNull()
    err = F.abs(F.col("actual") - F.col("forecast"))
    s = bt_short.where(ok).groupBy(*by).agg(F.avg(F.when(F.col("horizon_step") == 1, err)).alias("mae_1h"),
                                            F.avg(err).alias("mae_24h"))
    l = bt_long.where(ok).groupBy(*by).agg(F.avg(err).alias("mae_7d"))
    return s.join(l, by, "full")


def rank_methods(horizon_table: DataFrame, horizon_col: str = "horizon", metric: str = "MAE",
                 extra: Sequence[str] = ()) -> DataFrame:
    """Rank per horizon, nulls excluded."""
    w = Window.partitionBy(*extra, horizon_col).orderBy(F.col(metric), F.col("method"))
    return horizon_table.where(F.col(metric).isNotNull()).withColumn("rank", F.rank().over(w))


def agreement(a: DataFrame, b: DataFrame, tolerance: float = 0.02, by: Sequence[str] = ()) -> DataFrame:
    """Relative MAE gap of two scorings and whether they agree (gap < tol, equal n)."""
    by = list(by)
    sa = score(a, by).select(*by, F.col("MAE").alias("mae_a"), F.col("n").alias("n_a"))
    sb = score(b, by).select(*by, F.col("MAE").alias("mae_b"), F.col("n").alias("n_b"))
    if not by:  # two one-row scorings: join on a constant key
        sa, sb, by = sa.withColumn("_one", F.lit(1)), sb.withColumn("_one", F.lit(1)), ["_one"]
    j = sa.join(sb, by)
    gap = F.abs(F.col("mae_a") - F.col("mae_b")) / F.nullif(F.col("mae_b"), F.lit(0.0))
    by = [c for c in by if c != "_one"]
    return j.select(*by, "mae_a", "mae_b", "n_a", "n_b", gap.alias("rel_gap"),
                    ((gap < tolerance) & (F.col("n_a") == F.col("n_b"))).alias("agrees"))
