"""Minimum slice: grid → split → origins → baselines → backtest → leaderboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import backtest as B
from ..operators import metrics as M
from ..sources import tables as T
from . import oracle as O
from ..session import materialize
from .registry import out, register

# ---------------------------------------------------------------- shared inputs
BASELINES = [B.naive(), B.daily_seasonal_naive(), B.weekly_seasonal_naive(), B.tiled_profile(24)]


def hourly_backtest(spark: SparkSession, sf_dir: str, horizon: int = 24, test_frac: float = 0.2,
                    methods=None, grid: DataFrame | None = None) -> DataFrame:
    g = grid if grid is not None else materialize(T.hourly_grid(spark, sf_dir))
    split = B.split_point(g, test_frac)
    origins = B.forecast_origins(split, horizon, 24)
    return B.run_backtest(g, origins, methods or BASELINES, horizon)


# ---------------------------------------------------------------- minimum slice
@register("g5_hourly_grid", f"WITH {O.HOURLY} SELECT series_id, ts, round(y, {O.R}) AS y, n_events FROM hourly")
def g5_hourly_grid(spark, sf_dir):
    return out(T.hourly_grid(spark, sf_dir))


@register("b1_split_point", f"WITH {O.HOURLY}, {O.split_cte(0.2)} SELECT * FROM split")
def b1_split_point(spark, sf_dir):
    return B.split_point(T.hourly_grid(spark, sf_dir), 0.2)


@register("b3_origins", f"WITH {O.HOURLY}, {O.split_cte(0.2)}, {O.origins_cte(24, 24)} SELECT * FROM origins")
def b3_origins(spark, sf_dir):
    return B.forecast_origins(B.split_point(T.hourly_grid(spark, sf_dir), 0.2), 24, 24)


@register("b9_backtest", f"WITH {O.BT24} SELECT series_id, origin, horizon_step, method, "
                         f"round(actual, {O.R}) AS actual, round(forecast, {O.R}) AS forecast FROM bt")
def b9_backtest(spark, sf_dir):
    return out(hourly_backtest(spark, sf_dir))


@register("m6_leaderboard", f"""WITH {O.BT24}, lb AS (
  SELECT series_id, method, {O.metric_sql()} FROM bt GROUP BY 1, 2)
SELECT *, CAST(rank() OVER (PARTITION BY series_id ORDER BY MAE NULLS LAST, method) AS INTEGER) AS mae_rank
FROM lb""")
def m6_leaderboard(spark, sf_dir):
    lb = M.score(hourly_backtest(spark, sf_dir), ["series_id", "method"])
    lb = out(lb)
    w = Window.partitionBy("series_id").orderBy(F.col("MAE").asc_nulls_last(), "method")
    return lb.withColumn("mae_rank", F.rank().over(w))


@register("b2_chrono_split", f"""WITH {O.HOURLY},
d AS (SELECT series_id, ts, y, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn,
        count(*) OVER (PARTITION BY series_id) AS n FROM hourly WHERE y IS NOT NULL)
SELECT series_id, ts, round(y, {O.R}) AS y, CASE WHEN rn <= floor(n * 0.9) THEN 'train' ELSE 'test' END AS split
FROM d""")
def b2_chrono_split(spark, sf_dir):
    """90/10 time-ordered split of the non-missing hourly rows (no shuffling)."""
    g = T.hourly_grid(spark, sf_dir).select("series_id", "ts", "y")
    return out(B.chrono_split(g, 0.9, drop_null_cols=["y"]))


@register("q8_time_slice", f"""WITH {O.HOURLY}, {O.split_cte(0.2)}
SELECT h.series_id, h.ts, round(h.y, {O.R}) AS y, h.ts <= s.test_start AS in_train, h.ts >= s.test_start AS in_test
FROM hourly h JOIN split s ON h.series_id = s.series_id""")
def q8_time_slice(spark, sf_dir):
    """Inclusive slices: train ``[start, test_start]`` and test ``[test_start, end]``
    overlap in the test_start row, as label slicing does."""
    g = T.hourly_grid(spark, sf_dir)
    s = B.split_point(g, 0.2).select("series_id", "test_start")
    j = g.join(s, "series_id")
    return out(j.select("series_id", "ts", "y", (F.col("ts") <= F.col("test_start")).alias("in_train"),
                        (F.col("ts") >= F.col("test_start")).alias("in_test")))


@register("q9_clamp_ts", f"""WITH {O.HOURLY},
b AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM hourly GROUP BY 1),
req AS (SELECT DISTINCT event_type AS series_id, date_trunc('hour', ts) + INTERVAL 12 HOUR AS requested FROM events)
SELECT r.series_id, r.requested, least(greatest(r.requested, b.lo), b.hi) AS clamped
FROM req r JOIN b ON r.series_id = b.series_id""")
def q9_clamp_ts(spark, sf_dir):
    """Requested view times (each event's hour + 12 h) clamped into the series' valid range."""
    from ..functions.timecols import add_steps, floor_ts
    from ..operators.grid import series_bounds
    g = T.hourly_grid(spark, sf_dir)
    ev = T.read_table(spark, sf_dir, "events")
    req = ev.select(F.col("event_type").alias("series_id"),
                    add_steps(floor_ts("ts", "hour"), 12, "hour").alias("requested")).distinct()
    b = series_bounds(g, ["series_id"])
    return req.join(b, "series_id").select("series_id", "requested",
                                           F.least(F.greatest("requested", "_lo"), "_hi").alias("clamped"))
