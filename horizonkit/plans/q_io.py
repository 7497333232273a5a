"""Source/sink queries (S1–S14) and the streaming resample. Written tables go
under the shared checkpoint folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import inference as I
from ..session import scratch_path
from ..sources import store as S
from ..sources import tables as T
from ..streaming import resample as SR
from . import oracle as O
from .q_eval import bt168
from .q_core import hourly_backtest
from .q_prep import INTERP_SQL
from .registry import out, register

R = O.R


@register("s1_read_delimited", f"""WITH {O.MINUTE_GRID}
SELECT series_id, ts AS datetime, round(y, {R}) AS value, CAST(n_events AS DOUBLE) AS n_events FROM mgrid""")
def s1_read_delimited(spark, sf_dir):
    """The minute grid written in the raw ';'-delimited layout ('?' = missing,
    day-first dates) and parsed back with the raw reader."""
    path = scratch_path(spark, "raw-minute")
    S.write_delimited(T.minute_grid(spark, sf_dir), path, "ts", ["y", "n_events"], ["value", "n_events"],
                      extra_key="series_id")
    df = S.read_delimited(spark, path, ["Date", "Time", "value", "n_events"], rename={}, extra_key="series_id")
    return out(df)


@register("s2_table_roundtrip", f"WITH {O.HOURLY} SELECT series_id, count(*) AS n_rows FROM hourly GROUP BY 1")
def s2_table_roundtrip(spark, sf_dir):
    """Idempotent materialisation: writing twice replaces, the count is unchanged."""
    path = scratch_path(spark, "hourly")
    g = T.hourly_grid(spark, sf_dir)
    S.write_table(g, path, ["series_id"])
    S.write_table(g, path, ["series_id"])
    return spark.read.parquet(path).groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("s5_window_scan", f"""WITH {O.HOURLY},
latest AS (SELECT series_id, max(ts) AS as_of FROM hourly GROUP BY 1)
SELECT h.series_id, h.ts, round(h.y, {R}) AS y, h.n_events FROM hourly h JOIN latest l ON h.series_id = l.series_id
WHERE h.ts BETWEEN l.as_of - INTERVAL 192 HOUR AND l.as_of""")
def s5_window_scan(spark, sf_dir):
    g = T.hourly_grid(spark, sf_dir)
    return out(I.read_window(g, S.latest_origin(g), I.LOOKBACK))


@register("s6_latest_origin", f"WITH {O.HOURLY} SELECT series_id, max(ts) AS as_of FROM hourly GROUP BY 1")
def s6_latest_origin(spark, sf_dir):
    return S.latest_origin(T.hourly_grid(spark, sf_dir))


@register("s8_results_store", f"""WITH {O.BT24}, bt24 AS (SELECT * FROM bt),
{O.split_cte(0.5, name="split_l")}, {O.origins_cte(168, 24, split="split_l", name="origins_l")},
{O.backtest_cte(168, ("naive", "weekly_naive", "daily_profile"), origins="origins_l", name="btl")}
SELECT series_id, origin, horizon_step, method, round(actual, {R}) AS actual, round(forecast, {R}) AS forecast,
  '24h' AS result_set FROM bt24
UNION ALL SELECT series_id, origin, horizon_step, method, round(actual, {R}), round(forecast, {R}), '7d' FROM btl""")
def s8_results_store(spark, sf_dir):
    """Two result sets saved by name, then loaded together with their set name."""
    root = scratch_path(spark, "results")
    S.save_results(hourly_backtest(spark, sf_dir), root, "24h")
    S.save_results(bt168(spark, sf_dir), root, "7d")
    S.save_results(hourly_backtest(spark, sf_dir), root, "24h")  # re-run replaces its partition
    return out(S.load_results(spark, root))


@register("s9_forecast_sink")
def s9_forecast_sink(spark, sf_dir):
    root = scratch_path(spark, "forecasts")
    S.save_forecasts(hourly_backtest(spark, sf_dir).drop("actual"), root)
    return spark.read.parquet(root)


REFRESH_SQL = INTERP_SQL + f""",
filled AS (SELECT series_id, ts, CASE WHEN y IS NOT NULL THEN y
  WHEN ppos IS NOT NULL AND npos IS NOT NULL AND pos - ppos <= 180
  THEN pv + (nv - pv) * ((s - ps) * 1.0 / (ns - ps)) END AS y, n_events FROM q),
hr AS (SELECT series_id, date_trunc('hour', ts) AS ts, avg(y) AS y, CAST(sum(n_events) AS BIGINT) AS n_events
       FROM filled GROUP BY 1, 2),
hb2 AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM hr GROUP BY 1),
hi2 AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM hb2)"""


@register("s11_refresh", REFRESH_SQL + f"""
SELECT i.series_id, i.ts, round(hr.y, {R}) AS y, hr.n_events FROM hi2 i LEFT JOIN hr
  ON i.series_id = hr.series_id AND i.ts = hr.ts""")
def s11_refresh(spark, sf_dir):
    """Raw-to-hourly refresh: minute grid → interpolation (limit 3 h) → hourly."""
    return out(T.refreshed_hourly(spark, sf_dir))


@register("s12_run_log")
def s12_run_log(spark, sf_dir):
    """Run log rows for the baseline backtest: parameters and per-method MAE."""
    from ..operators import metrics as M
    path = scratch_path(spark, "runs")
    lb = M.score(hourly_backtest(spark, sf_dir), ["method"]).select("method", "MAE", "n")
    metrics = {f"{r['method']}_mae": r["MAE"] for r in lb.collect()}  # one row per method
    S.log_run(spark, path, "baselines", {"horizon": 24, "test_frac": 0.2, "origin_every": 24}, metrics)
    return spark.read.parquet(path)


@register("s14_model_registry")
def s14_model_registry(spark, sf_dir):
    """Train the production bundle through the test start (I6), save it (S13),
    register two versions and move the 'champion' alias (S14)."""
    from .q_models import HORIZONS, MODEL_FEATURES, fit_models
    g, split, f, models = fit_models(spark, sf_dir)
    root = scratch_path(spark, "bundle")
    S.save_bundle(models, root, spark, {"feature_cols": MODEL_FEATURES, "target_col": "y",
                                        "horizons": list(HORIZONS)})
    loaded, meta = S.load_bundle(spark, root)
    reg = scratch_path(spark, "registry")
    S.register_version(spark, reg, "demand_direct", root, alias="champion")
    S.register_version(spark, reg, "demand_direct", root, alias="champion")
    return S.resolve_alias(spark, reg, "demand_direct", "champion")


@register("r1_stream_hourly", f"""SELECT event_type AS series_id, date_trunc('hour', ts) AS ts,
  round(avg(value), {R}) AS y_mean, round(sum(value), {R}) AS y_sum, count(*) AS n_events
FROM events GROUP BY 1, 2
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def r1_stream_hourly(spark, sf_dir):
    """Hourly bins computed by the streaming operator over the events table
    (files replayed with availableNow); the bins still open under the 2-hour
    watermark at the end of the data are not emitted yet."""
    ev = T.read_table(spark, sf_dir, "events")
    outp, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    df = SR.run_to_table(spark, sf_dir, ev.schema, outp, ck, glob="events.parquet")
    return out(df)


@register("s11_refresh_changed")
def s11_refresh_changed(spark, sf_dir):
    """The tables brought from the events before their last two days to all events: days
    rewritten, then the hourly table as it stands."""
    from .refresh import refresh_changed
    root = scratch_path(spark, "refresh-changed")
    raw = T.read_table(spark, sf_dir, "events").select("event_type", "ts", "value")
    last = raw.agg(F.max("ts").alias("t"))
    refresh_changed(raw.join(last, how="cross").where("ts < date_trunc('day', t) - interval 1 day").drop("t"), root)
    days = refresh_changed(raw, root)
    hourly = spark.read.parquet(f"{root}/hourly")
    return out(hourly.select("series_id", "ts", "y", "n_events", F.col("day").isin(days).alias("rewritten")))


@register("s11_refresh_job")
def s11_refresh_job(spark, sf_dir):
    """The full raw-to-features refresh written as day-partitioned tables (run twice: idempotent)."""
    from .refresh import run_refresh
    root = scratch_path(spark, "refresh")
    run_refresh(spark, sf_dir, root)
    return run_refresh(spark, sf_dir, root)
