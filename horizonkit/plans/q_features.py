"""Feature-engineering queries (F1–F13) and the drop-null report (V6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timecols import day_of
from ..operators import backtest as B
from ..operators import features as FE
from ..operators import quality as V
from ..sources import tables as T
from . import oracle as O
from ..session import materialize
from .registry import out, register

R = O.R
W = "PARTITION BY series_id ORDER BY ts"
SEASON = ("CASE WHEN month({c}) IN (12,1,2) THEN 'winter' WHEN month({c}) IN (3,4,5) THEN 'spring' "
          "WHEN month({c}) IN (6,7,8) THEN 'summer' ELSE 'fall' END")


def cal_sql(c: str = "ts") -> str:
    return (f"CAST(hour({c}) AS INTEGER) AS hour, CAST(isodow({c}) - 1 AS INTEGER) AS dayofweek, "
            f"CAST(month({c}) AS INTEGER) AS month, CAST(quarter({c}) AS INTEGER) AS quarter, "
            f"CAST(isodow({c}) >= 6 AS INTEGER) AS is_weekend, {SEASON.format(c=c)} AS season")


def cyc_sql(h: str, d: str, m: str, prefix: str = "") -> str:
    out = []
    for name, c, p in (("hour", h, 24), ("dayofweek", d, 7), ("month", m, 12)):
        out.append(f"round(sin(2 * pi() * {c} / {p}), {R}) AS {prefix}{name}_sin")
        out.append(f"round(cos(2 * pi() * {c} / {p}), {R}) AS {prefix}{name}_cos")
    return ", ".join(out)


def lag_sql(col="y", ks=FE.LAGS) -> str:
    return ", ".join(f"round(lag({col}, {k}) OVER ({W}), {R}) AS {col}_lag_{k}" for k in ks)


def roll_sql(col="y", ns=FE.ROLLING) -> str:
    out = []
    for n in ns:
        fr = f"({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        full = f"count({col}) OVER {fr} = {n}"
        for agg, name in (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max")):
            out.append(f"round(CASE WHEN {full} THEN {agg}({col}) OVER {fr} END, {R}) AS {col}_roll_{name}_{n}")
    return ", ".join(out)


def mom_sql(col="y") -> str:
    l1, l2, l25 = (f"lag({col}, {k}) OVER ({W})" for k in (1, 2, 25))
    return (f"round({l1} - {l2}, {R}) AS {col}_diff_1, round({l1} - {l25}, {R}) AS {col}_diff_24, "
            f"round(({l1} - {l2}) / nullif({l2}, 0), {R}) AS {col}_pct_change_1, "
            f"round(({l1} - {l25}) / nullif({l25}, 0), {R}) AS {col}_pct_change_24")


FLAGGED_SQL = "flagged AS (SELECT DISTINCT series_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM hourly WHERE y IS NULL)"
FEATURES_SQL = f"""{O.HOURLY}, {FLAGGED_SQL},
cal AS (SELECT *, {cal_sql()} FROM hourly),
feat AS (SELECT series_id, ts, round(y, {R}) AS y, n_events, hour, dayofweek, month, quarter, is_weekend, season,
  {cyc_sql('hour', 'dayofweek', 'month')}, {lag_sql()}, {roll_sql()}, {mom_sql()},
  CAST((series_id, CAST(CAST(ts AS DATE) AS TIMESTAMP)) IN (SELECT (series_id, day) FROM flagged) AS INTEGER) AS is_flagged_anomaly
  FROM cal)"""


def flagged_days(hourly):
    """Days on which a series has a missing hour (data-derived flag table)."""
    return hourly.where(F.col("y").isNull()).select("series_id", day_of("ts").alias("day")).distinct()


def features(spark, sf_dir):
    h = materialize(T.hourly_grid(spark, sf_dir))  # read by the flag table and the features
    return FE.build_features(h, "y", flagged_days(h))


@register("f1_calendar", f"WITH {O.HOURLY} SELECT series_id, ts, round(y, {R}) AS y, n_events, {cal_sql()} FROM hourly")
def f1_calendar(spark, sf_dir):
    return out(FE.calendar(T.hourly_grid(spark, sf_dir)))


@register("f2_cyclical", f"""WITH {O.HOURLY}, cal AS (SELECT *, {cal_sql()} FROM hourly)
SELECT series_id, ts, round(y, {R}) AS y, n_events, hour, dayofweek, month, quarter, is_weekend, season,
  {cyc_sql('hour', 'dayofweek', 'month')} FROM cal""")
def f2_cyclical(spark, sf_dir):
    return out(FE.cyclical(FE.calendar(T.hourly_grid(spark, sf_dir))))


@register("f3_lags", f"WITH {O.HOURLY} SELECT series_id, ts, round(y, {R}) AS y, n_events, {lag_sql()} FROM hourly")
def f3_lags(spark, sf_dir):
    return out(FE.lags(T.hourly_grid(spark, sf_dir)))


@register("f4_rolling", f"WITH {O.HOURLY} SELECT series_id, ts, round(y, {R}) AS y, n_events, {roll_sql()} FROM hourly")
def f4_rolling(spark, sf_dir):
    return out(FE.rolling(T.hourly_grid(spark, sf_dir)))


@register("f5_momentum", f"WITH {O.HOURLY} SELECT series_id, ts, round(y, {R}) AS y, n_events, {mom_sql()} FROM hourly")
def f5_momentum(spark, sf_dir):
    return out(FE.momentum(T.hourly_grid(spark, sf_dir)))


@register("f6_day_flag", f"""WITH {O.HOURLY}, {FLAGGED_SQL}
SELECT series_id, ts, round(y, {R}) AS y, n_events,
  CAST((series_id, CAST(CAST(ts AS DATE) AS TIMESTAMP)) IN (SELECT (series_id, day) FROM flagged) AS INTEGER) AS is_flagged_anomaly FROM hourly""")
def f6_day_flag(spark, sf_dir):
    h = T.hourly_grid(spark, sf_dir)
    return out(FE.day_flag(h, flagged_days(h)))


@register("f7_features", f"WITH {FEATURES_SQL} SELECT * FROM feat")
def f7_features(spark, sf_dir):
    return out(features(spark, sf_dir))


def _target_sql(h: int) -> str:
    t = f"(ts + INTERVAL {h} HOUR)"
    return (f"SELECT series_id, ts, {h} AS horizon, "
            f"{cyc_sql(f'hour({t})', f'(isodow({t}) - 1)', f'month({t})', 'target_')}, "
            f"CAST(isodow({t}) >= 6 AS INTEGER) AS target_is_weekend, "
            f"round(lead(y, {h}) OVER ({W}), {R}) AS y_target FROM hourly")


@register("f8_supervised", f"WITH {O.HOURLY} " + " UNION ALL ".join(_target_sql(h) for h in (1, 24)))
def f8_supervised(spark, sf_dir):
    h = T.hourly_grid(spark, sf_dir).select("series_id", "ts", "y")
    s = FE.supervised(h, [1, 24])
    return out(s.drop("y"))


FEATURE_COLS = ["y_lag_1", "y_lag_24", "y_roll_mean_24", "hour_sin", "hour_cos"]


@register("f9_train_mask", f"""WITH {O.HOURLY}, {O.split_cte(0.2)},
cal AS (SELECT *, {cal_sql()} FROM hourly),
f AS (SELECT series_id, ts, {cyc_sql('hour', 'dayofweek', 'month')}, {lag_sql()}, {roll_sql()} FROM cal),
sup AS ({" UNION ALL ".join(f"SELECT series_id, ts, {h} AS horizon, lead(y, {h}) OVER ({W}) AS y_target FROM hourly"
                            for h in (1, 24))})
SELECT s.series_id, s.ts, s.horizon, round(s.y_target, {R}) AS y_target
FROM sup s JOIN f ON s.series_id = f.series_id AND s.ts = f.ts JOIN split p ON s.series_id = p.series_id
WHERE s.ts <= p.test_start - INTERVAL 1 HOUR * s.horizon AND s.y_target IS NOT NULL
  AND {" AND ".join(f"f.{c} IS NOT NULL" for c in FEATURE_COLS)}""")
def f9_train_mask(spark, sf_dir):
    h = T.hourly_grid(spark, sf_dir)
    f = FE.cyclical(FE.calendar(h))
    f = FE.rolling(FE.lags(f))
    sup = FE.supervised(f, [1, 24])
    split = B.split_point(h, 0.2).select("series_id", "test_start")
    m = FE.train_mask(sup.join(split, "series_id"), F.col("test_start"), FEATURE_COLS)
    return out(m.select("series_id", "ts", "horizon", "y_target"))


@register("f10_windows")
def f10_windows(spark, sf_dir):
    """48-step look-back of (y, calendar) and 24-step target windows at every valid origin."""
    f = FE.calendar(T.hourly_grid(spark, sf_dir))
    return FE.windows(f, 48, 24, ["y", "hour", "dayofweek", "month", "quarter", "is_weekend"], "y")


@register("f11_scaler", f"""WITH {O.HOURLY}, {O.split_cte(0.2)}
SELECT h.series_id, round(avg(y), {R}) AS scale_mean, round(stddev_samp(y), {R}) AS scale_std
FROM hourly h JOIN split s ON h.series_id = s.series_id WHERE h.ts < s.test_start GROUP BY 1""")
def f11_scaler(spark, sf_dir):
    h = T.hourly_grid(spark, sf_dir)
    train = h.join(B.split_point(h, 0.2), "series_id").where(F.col("ts") < F.col("test_start"))
    return out(FE.fit_scaler(train))


@register("f12_scale_windows")
def f12_scale_windows(spark, sf_dir):
    h = T.hourly_grid(spark, sf_dir)
    train = h.join(B.split_point(h, 0.2), "series_id").where(F.col("ts") < F.col("test_start"))
    win = FE.windows(FE.calendar(h), 48, 24, ["y", "hour", "dayofweek"], "y")
    return FE.scale_windows(win, FE.fit_scaler(train))


@register("f13_standardize", f"""WITH {O.LINEITEM_DAILY}
SELECT series_id, ts, {", ".join(f"round(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), {R}) AS {c}"
                                 for c in T.LINEITEM_MEASURES)} FROM li_daily""")
def f13_standardize(spark, sf_dir):
    return out(FE.standardize(T.lineitem_daily(spark, sf_dir), list(T.LINEITEM_MEASURES)))


@register("v6_dropna_report", f"""WITH {FEATURES_SQL}
SELECT series_id, count(*) AS rows_before,
  count(*) FILTER (WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [
      "y", "n_events", "y_lag_1", "y_lag_6", "y_lag_24", "y_lag_168", "y_roll_mean_24", "y_roll_std_24",
      "y_roll_min_24", "y_roll_max_24", "y_roll_mean_168", "y_roll_std_168", "y_roll_min_168", "y_roll_max_168",
      "y_diff_1", "y_diff_24", "y_pct_change_1", "y_pct_change_24"])}) AS rows_after,
  count(*) - count(*) FILTER (WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [
      "y", "n_events", "y_lag_1", "y_lag_6", "y_lag_24", "y_lag_168", "y_roll_mean_24", "y_roll_std_24",
      "y_roll_min_24", "y_roll_max_24", "y_roll_mean_168", "y_roll_std_168", "y_roll_min_168", "y_roll_max_168",
      "y_diff_1", "y_diff_24", "y_pct_change_1", "y_pct_change_24"])}) AS rows_lost
FROM feat GROUP BY 1""")
def v6_dropna_report(spark, sf_dir):
    r = V.drop_null_report(features(spark, sf_dir), ["series_id"])
    return out(r.drop("lost_pct"))
