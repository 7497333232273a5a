"""Evaluation queries: metrics tables, comparisons, significance, business measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import point_loss
from ..functions.timecols import day_of
from ..operators import backtest as B
from ..operators import compare as C
from ..operators import metrics as M
from ..sources import tables as T
from . import oracle as O
from .q_core import BASELINES, hourly_backtest
from ..session import materialize
from .registry import out, register

R = O.R
KS = ["series_id"]
BT168 = ",\n".join([O.HOURLY, O.split_cte(0.5), O.origins_cte(168, 24),
                    O.backtest_cte(168, ("naive", "weekly_naive", "daily_profile"), name="bt")])
LONG_METHODS = [B.naive(), B.weekly_seasonal_naive(), B.tiled_profile(24)]
DM_METHODS = ["daily_naive", "weekly_naive", "naive", "daily_profile"]


def bt24(spark, sf_dir, grid=None):
    return hourly_backtest(spark, sf_dir, grid=grid)


def bt168(spark, sf_dir, grid=None):
    return hourly_backtest(spark, sf_dir, horizon=168, test_frac=0.5, methods=LONG_METHODS, grid=grid)


# ---------------------------------------------------------------- M5–M13
@register("m5_metrics", f"WITH {O.BT24} SELECT series_id, {O.metric_sql()} FROM bt WHERE method = 'daily_naive' GROUP BY 1")
def m5_metrics(spark, sf_dir):
    return out(M.score(bt24(spark, sf_dir).where(F.col("method") == "daily_naive"), KS))


@register("m7_by_step", f"WITH {O.BT24} SELECT series_id, method, horizon_step, {O.metric_sql()} FROM bt GROUP BY 1, 2, 3")
def m7_by_step(spark, sf_dir):
    return out(M.by_step(bt24(spark, sf_dir), KS))


FOLDS_SQL = "folds AS (SELECT origin, CAST(ntile(4) OVER (ORDER BY origin) - 1 AS INTEGER) AS fold " \
            "FROM (SELECT DISTINCT origin FROM bt) d)"


@register("m8_by_fold", f"""WITH {O.BT24}, {FOLDS_SQL}
SELECT series_id, method, fold, {O.metric_sql()} FROM bt JOIN folds USING (origin) GROUP BY 1, 2, 3""")
def m8_by_fold(spark, sf_dir):
    bt = bt24(spark, sf_dir)
    return out(M.by_fold(bt, C.assign_folds(bt, 4), KS))


SEASON_SQL = ("CASE WHEN month(origin) IN (12,1,2) THEN 'winter' WHEN month(origin) IN (3,4,5) THEN 'spring' "
              "WHEN month(origin) IN (6,7,8) THEN 'summer' ELSE 'fall' END")


@register("m9_by_season", f"""WITH {O.BT24}
SELECT series_id, method, {SEASON_SQL} AS season, {O.metric_sql()} FROM bt GROUP BY 1, 2, 3""")
def m9_by_season(spark, sf_dir):
    return out(M.by_season(bt24(spark, sf_dir), KS))


def _ok(a="actual", f="forecast"):
    return f"{a} IS NOT NULL AND {f} IS NOT NULL"


@register("m10_horizon_exact", f"""WITH {BT168}
SELECT series_id, method, {", ".join(f"round(avg(CASE WHEN horizon_step = {k} THEN abs(actual - forecast) END), {R}) AS mae_h{k}"
                                     for k in (1, 24, 168))}
FROM bt WHERE {_ok()} GROUP BY 1, 2""")
def m10_horizon_exact(spark, sf_dir):
    return out(M.horizon_exact(bt168(spark, sf_dir), (1, 24, 168), ["series_id", "method"]))


M11_SQL = f"""{O.BT24}, bt24 AS (SELECT * FROM bt),
{O.split_cte(0.5, name="split_l")}, {O.origins_cte(168, 24, split="split_l", name="origins_l")},
{O.backtest_cte(168, ("naive", "weekly_naive", "daily_profile"), origins="origins_l", name="btl")},
s AS (SELECT series_id, method, avg(CASE WHEN horizon_step = 1 THEN abs(actual - forecast) END) AS mae_1h,
        avg(abs(actual - forecast)) AS mae_24h FROM bt24 WHERE {_ok()} GROUP BY 1, 2),
l AS (SELECT series_id, method, avg(abs(actual - forecast)) AS mae_7d FROM btl WHERE {_ok()} GROUP BY 1, 2),
m11 AS (SELECT coalesce(s.series_id, l.series_id) AS series_id, coalesce(s.method, l.method) AS method,
          mae_1h, mae_24h, mae_7d FROM s FULL JOIN l ON s.series_id = l.series_id AND s.method = l.method)"""


def m11(spark, sf_dir):
    g = materialize(T.hourly_grid(spark, sf_dir))
    return M.horizon_avg(bt24(spark, sf_dir, g), bt168(spark, sf_dir, g), ["series_id", "method"])


@register("m11_horizon_avg", f"WITH {M11_SQL} SELECT series_id, method, round(mae_1h, {R}) AS mae_1h, "
                             f"round(mae_24h, {R}) AS mae_24h, round(mae_7d, {R}) AS mae_7d FROM m11")
def m11_horizon_avg(spark, sf_dir):
    return out(m11(spark, sf_dir))


@register("m12_rank", f"""WITH {M11_SQL},
lng AS (SELECT series_id, method, '1h' AS horizon, round(mae_1h, {R}) AS MAE FROM m11
        UNION ALL SELECT series_id, method, '24h', round(mae_24h, {R}) FROM m11
        UNION ALL SELECT series_id, method, '7d', round(mae_7d, {R}) FROM m11)
SELECT *, CAST(rank() OVER (PARTITION BY series_id, horizon ORDER BY MAE, method) AS INTEGER) AS rank
FROM lng WHERE MAE IS NOT NULL""")
def m12_rank(spark, sf_dir):
    t = out(m11(spark, sf_dir))
    lng = t.select("series_id", "method", F.inline(F.array(
        F.struct(F.lit("1h").alias("horizon"), F.col("mae_1h").alias("MAE")),
        F.struct(F.lit("24h").alias("horizon"), F.col("mae_24h").alias("MAE")),
        F.struct(F.lit("7d").alias("horizon"), F.col("mae_7d").alias("MAE")))))
    return M.rank_methods(lng, "horizon", "MAE", KS)


@register("m13_agreement", f"""WITH {O.BT24},
a AS (SELECT series_id, avg(abs(actual - forecast)) AS mae_a, count(*) AS n_a FROM bt
      WHERE method = 'daily_profile' AND {_ok()} GROUP BY 1),
b AS (SELECT series_id, avg(abs(actual - forecast)) AS mae_b, count(*) AS n_b FROM bt
      WHERE method = 'daily_naive' AND {_ok()} GROUP BY 1)
SELECT a.series_id, round(mae_a, {R}) AS mae_a, round(mae_b, {R}) AS mae_b, n_a, n_b,
  round(abs(mae_a - mae_b) / mae_b, {R}) AS rel_gap, (abs(mae_a - mae_b) / mae_b < 0.02 AND n_a = n_b) AS agrees
FROM a JOIN b ON a.series_id = b.series_id""")
def m13_agreement(spark, sf_dir):
    """Tiled profile vs daily seasonal naive: identical for h <= 24 by construction."""
    bt = bt24(spark, sf_dir)
    return out(M.agreement(bt.where(F.col("method") == "daily_profile"), bt.where(F.col("method") == "daily_naive"),
                           0.02, KS))


@register("b14_coverage", f"""WITH {O.BT24},
no AS (SELECT series_id, count(*) AS n_origins FROM origins GROUP BY 1),
c AS (SELECT series_id, method, count(*) FILTER (WHERE {_ok()}) AS scored_pairs, count(DISTINCT origin) AS origins_used
      FROM bt GROUP BY 1, 2)
SELECT c.series_id, method, scored_pairs, origins_used, n_origins * 24 AS possible_pairs,
  round(scored_pairs * 100.0 / nullif(n_origins * 24, 0), {R}) AS coverage_pct
FROM c JOIN no ON c.series_id = no.series_id""")
def b14_coverage(spark, sf_dir):
    g = T.hourly_grid(spark, sf_dir)
    origins = B.forecast_origins(B.split_point(g, 0.2), 24, 24)
    bt = B.run_backtest(g, origins, BASELINES, 24)
    n = origins.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_origins"))
    return out(B.coverage(bt, n, 24))


@register("b8_tiled_profile_168", f"""WITH {BT168} SELECT series_id, origin, horizon_step, method,
  round(actual, {R}) AS actual, round(forecast, {R}) AS forecast FROM bt""")
def b8_tiled_profile_168(spark, sf_dir):
    """Seven-day backtest: flat, weekly and tiled daily profile (valid beyond 24 steps)."""
    return out(bt168(spark, sf_dir))


# ---------------------------------------------------------------- C1–C11
@register("c1_season", f"WITH {O.BT24} SELECT DISTINCT series_id, origin, {SEASON_SQL} AS season FROM bt")
def c1_season(spark, sf_dir):
    return C.add_season(bt24(spark, sf_dir).select("series_id", "origin").distinct())


@register("c2_folds", f"WITH {O.BT24}, {FOLDS_SQL} SELECT * FROM folds")
def c2_folds(spark, sf_dir):
    return C.assign_folds(bt24(spark, sf_dir), 4)


@register("c3_fold_labels", f"""WITH {O.BT24}, {FOLDS_SQL}
SELECT fold, min(origin) AS fold_start, max(origin) AS fold_end,
  strftime(min(origin), '%b %d') || ' - ' || strftime(max(origin), '%b %d') AS label FROM folds GROUP BY 1""")
def c3_fold_labels(spark, sf_dir):
    return C.fold_labels(C.assign_folds(bt24(spark, sf_dir), 4))


OL_SQL = f"""ol AS (SELECT series_id, method, origin, avg(abs(actual - forecast)) AS loss FROM bt
  WHERE {_ok()} AND method IN ({", ".join(f"'{m}'" for m in DM_METHODS)}) GROUP BY 1, 2, 3)"""


@register("c5_origin_loss", f"WITH {O.BT24}, {OL_SQL} SELECT series_id, method, origin, round(loss, {R}) AS loss FROM ol")
def c5_origin_loss(spark, sf_dir):
    return out(C.origin_loss(bt24(spark, sf_dir), "absolute", KS, DM_METHODS))


DM_SQL = f"""{O.BT24}, {OL_SQL},
ord AS (SELECT * FROM (VALUES {", ".join(f"('{m}', {i})" for i, m in enumerate(DM_METHODS))}) t(method, method_rank)),
l AS (SELECT ol.*, method_rank FROM ol JOIN ord ON ol.method = ord.method),
pairs AS (SELECT a.series_id, a.method AS method_a, b.method AS method_b, a.origin, a.loss - b.loss AS d
          FROM l a JOIN l b ON a.series_id = b.series_id AND a.origin = b.origin AND a.method_rank < b.method_rank),
s AS (SELECT series_id, method_a, method_b, count(*) AS n_origins, avg(d) AS mean_loss_diff, var_pop(d) AS g0
      FROM pairs GROUP BY 1, 2, 3)"""


@register("c6_dm_statistic", f"""WITH {DM_SQL}
SELECT series_id, method_a, method_b, round(mean_loss_diff, {R}) AS mean_loss_diff,
  round(CASE WHEN g0 > 1e-18 THEN mean_loss_diff / sqrt(g0 / n_origins)
        * sqrt((n_origins + 1 - 2 * 1 + 1 * 0 / n_origins) / n_origins) END, {R}) AS dm_statistic, n_origins
FROM s""")
def c6_dm_statistic(spark, sf_dir):
    return out(C.dm_statistics(bt24(spark, sf_dir), DM_METHODS, "absolute", 1, KS))


@register("c7_dm_tests")
def c7_dm_tests(spark, sf_dir):
    """All pairs with p-values (Student-t, n-1) and the significance flag."""
    return out(C.dm_tests(bt24(spark, sf_dir), DM_METHODS, "absolute", 2, KS))


WORST_SQL = f"""worst AS (SELECT * FROM (
  SELECT series_id, origin, horizon_step, method, actual, forecast, abs(actual - forecast) AS loss,
    row_number() OVER (PARTITION BY series_id, method ORDER BY abs(actual - forecast) DESC, origin, horizon_step)
      AS case_rank
  FROM bt WHERE {_ok()}) t WHERE case_rank <= 10)"""


@register("c8_worst_cases", f"""WITH {O.BT24}, {WORST_SQL}
SELECT series_id, origin, horizon_step, method, round(actual, {R}) AS actual, round(forecast, {R}) AS forecast,
  round(loss, {R}) AS loss, CAST(case_rank AS INTEGER) AS case_rank FROM worst""")
def c8_worst_cases(spark, sf_dir):
    return out(C.worst_cases(bt24(spark, sf_dir), 10))


CONTEXT_SQL = f"""{O.BT24}, {WORST_SQL},
hg AS (SELECT series_id, ts, y IS NULL AS miss,
         row_number() OVER (PARTITION BY series_id ORDER BY ts)
         - row_number() OVER (PARTITION BY series_id, y IS NULL ORDER BY ts) AS grp FROM hourly),
ranges AS (SELECT series_id, min(ts) AS range_start, max(ts) AS range_end FROM hg WHERE miss GROUP BY series_id, grp),
z AS (SELECT series_id, ts, (y - avg(y) OVER (PARTITION BY series_id)) / stddev_samp(y) OVER (PARTITION BY series_id) AS z
      FROM hourly),
fdays AS (SELECT DISTINCT series_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM z WHERE abs(z) > 3),
lab AS (SELECT w.*, CASE
    WHEN EXISTS (SELECT 1 FROM ranges r WHERE r.series_id = w.series_id AND CAST(CAST(w.origin AS DATE) AS TIMESTAMP)
                 BETWEEN CAST(CAST(r.range_start AS DATE) AS TIMESTAMP) AND CAST(CAST(r.range_end AS DATE) AS TIMESTAMP))
      THEN 'near_data_gap'
    WHEN (w.series_id, CAST(CAST(w.origin AS DATE) AS TIMESTAMP)) IN (SELECT (series_id, day) FROM fdays) THEN 'flagged_anomaly'
    ELSE '' END AS context FROM worst w)"""


def labelled_cases(spark, sf_dir):
    """Worst cases labelled by gap ranges (hourly gap islands) and flagged days
    (hours with |z| > 3 against their series)."""
    from ..operators import anomaly as A
    from ..operators import grid as G
    g = materialize(T.hourly_grid(spark, sf_dir))
    bt = hourly_backtest(spark, sf_dir, grid=g)
    cases = C.worst_cases(bt, 10)
    ranges = G.find_gaps(g, ["y"], step="hour").select("series_id", F.col("start").alias("range_start"),
                                                       F.col("end").alias("range_end"))
    days = A.zscore(g).where(F.col("zscore_flag")).select("series_id", day_of("ts").alias("day"))
    return C.label_context(cases, ranges, days)


@register("c9_label_context", f"""WITH {CONTEXT_SQL}
SELECT series_id, origin, horizon_step, method, round(actual, {R}) AS actual, round(forecast, {R}) AS forecast,
  round(loss, {R}) AS loss, CAST(case_rank AS INTEGER) AS case_rank, context FROM lab""")
def c9_label_context(spark, sf_dir):
    return out(labelled_cases(spark, sf_dir))


@register("c10_flagged_share", f"""WITH {CONTEXT_SQL}
SELECT series_id, method, round(avg(CAST(context <> '' AS DOUBLE)), {R}) AS flagged_share, count(*) AS n_cases
FROM lab GROUP BY 1, 2""")
def c10_flagged_share(spark, sf_dir):
    return out(C.flagged_share(labelled_cases(spark, sf_dir)))


# ---------------------------------------------------------------- K1–K2
K_SQL = f"""{O.BT24},
lb AS (SELECT series_id, method, avg(CASE WHEN {_ok()} THEN abs(actual - forecast) END) AS MAE FROM bt GROUP BY 1, 2),
imp AS (SELECT l.series_id, l.method, l.MAE, b.MAE AS baseline_mae, (b.MAE - l.MAE) / b.MAE * 100 AS improvement_pct
        FROM lb l JOIN lb b ON l.series_id = b.series_id AND b.method = 'naive')"""


@register("k1_improvement", f"""WITH {K_SQL}
SELECT series_id, method, round(MAE, {R}) AS MAE, round(baseline_mae, {R}) AS baseline_mae,
  round(improvement_pct, {R}) AS improvement_pct FROM imp""")
def k1_improvement(spark, sf_dir):
    lb = M.score(bt24(spark, sf_dir), ["series_id", "method"]).select("series_id", "method", "MAE")
    return out(C.improvement(lb, "naive", KS))


@register("k2_avoided_cost", f"""WITH {K_SQL}
SELECT series_id, method, round(MAE, {R}) AS MAE, round(baseline_mae, {R}) AS baseline_mae,
  round(improvement_pct, {R}) AS improvement_pct, CAST(10000 AS BIGINT) AS households,
  CAST(20.0 AS DOUBLE) AS premium_per_mwh,
  round((baseline_mae - MAE) * 8760 * 10000 / 1000 * 20.0, {R}) AS avoided_cost FROM imp""")
def k2_avoided_cost(spark, sf_dir):
    lb = M.score(bt24(spark, sf_dir), ["series_id", "method"]).select("series_id", "method", "MAE")
    return out(C.avoided_cost(C.improvement(lb, "naive", KS), C.params_table(spark)))


@register("c4_point_loss", f"""WITH {O.BT24}
SELECT series_id, origin, horizon_step, method, round(abs(actual - forecast), {R}) AS abs_loss,
  round((actual - forecast) * (actual - forecast), {R}) AS sq_loss FROM bt WHERE {_ok()}""")
def c4_point_loss(spark, sf_dir):
    bt = bt24(spark, sf_dir).where(F.col("actual").isNotNull() & F.col("forecast").isNotNull())
    return out(bt.select("series_id", "origin", "horizon_step", "method", point_loss("absolute").alias("abs_loss"),
                         point_loss("squared").alias("sq_loss")))


METHOD_COLUMNS = ", ".join(f"max(CASE WHEN method = '{m}' THEN mae END) AS {m}" for m in ("naive", "daily_naive", "weekly_naive", "daily_profile"))


@register("m9_season_matrix", f"""WITH {O.BT24}, s AS (
  SELECT series_id, {SEASON_SQL} AS season, method, round(avg(abs(actual - forecast)), {R}) AS mae
  FROM bt WHERE {_ok()} GROUP BY 1, 2, 3)
SELECT series_id, season, {METHOD_COLUMNS} FROM s GROUP BY 1, 2""")
def m9_season_matrix(spark, sf_dir):
    """Season × method MAE matrix (the pivoted view of M9)."""
    t = M.by_season(bt24(spark, sf_dir), KS)
    return out(t.groupBy("series_id", "season").pivot("method").agg(F.first("MAE")))


@register("m8_fold_matrix", f"""WITH {O.BT24}, {FOLDS_SQL}, s AS (
  SELECT series_id, fold, method, round(avg(abs(actual - forecast)), {R}) AS mae
  FROM bt JOIN folds USING (origin) WHERE {_ok()} GROUP BY 1, 2, 3)
SELECT series_id, fold, {METHOD_COLUMNS} FROM s GROUP BY 1, 2""")
def m8_fold_matrix(spark, sf_dir):
    """Fold × method MAE matrix (the pivoted view of M8)."""
    bt = bt24(spark, sf_dir)
    t = M.by_fold(bt, C.assign_folds(bt, 4), KS)
    return out(t.groupBy("series_id", "fold").pivot("method").agg(F.first("MAE")))
