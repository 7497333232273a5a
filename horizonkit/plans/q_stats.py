"""Exploratory statistics (E1–E7) and anomaly (A1–A8) queries on the daily order series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as A
from ..operators import features as FE
from ..operators import grid as G
from ..operators import profile as P
from ..operators import stats as S
from ..operators import stl as ST
from ..operators import unit_root as U
from ..sources import tables as T
from . import oracle as O
from .q_prep import DAILY_INTERP, holiday_cte
from ..session import materialize
from .registry import out, register

R = O.R
PW = "PARTITION BY series_id ORDER BY ts"


def filled_daily(spark, sf_dir):
    return G.interpolate_position(T.daily_grid(spark, sf_dir), ["y"], step="day")


DECOMP_SQL = f"""{DAILY_INTERP.replace("WITH ", "", 1)},
t AS (SELECT series_id, ts, y, n_orders,
  CASE WHEN count(y) OVER ({PW} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7
       THEN avg(y) OVER ({PW} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS trend,
  CAST(date_diff('day', min(ts) OVER (PARTITION BY series_id), ts) % 7 AS INTEGER) AS phase FROM filled),
pm AS (SELECT series_id, phase, avg(y - trend) AS pm FROM t GROUP BY 1, 2),
pmm AS (SELECT series_id, avg(pm) AS pmm FROM pm GROUP BY 1),
dec AS (SELECT t.series_id, t.ts, t.y, t.n_orders, t.trend, t.phase, pm.pm - pmm.pmm AS seasonal,
          t.y - t.trend - (pm.pm - pmm.pmm) AS resid
        FROM t JOIN pm ON t.series_id = pm.series_id AND t.phase = pm.phase
        JOIN pmm ON t.series_id = pmm.series_id)"""


def decomposed(spark, sf_dir):
    return S.decompose(filled_daily(spark, sf_dir), "y", 7)


@register("e1_decompose", f"""WITH {DECOMP_SQL}
SELECT series_id, ts, round(y, {R}) AS y, n_orders, round(trend, {R}) AS trend, phase, round(seasonal, {R}) AS seasonal,
  round(resid, {R}) AS resid FROM dec""")
def e1_decompose(spark, sf_dir):
    return out(decomposed(spark, sf_dir))


def stl_daily(spark, sf_dir, period):
    return ST.stl(filled_daily(spark, sf_dir), "y", period)


@register("e1_stl")
def e1_stl(spark, sf_dir):
    return out(stl_daily(spark, sf_dir, 7))


@register("e1_stl_yearly")
def e1_stl_yearly(spark, sf_dir):
    return out(stl_daily(spark, sf_dir, 365))


def acf_sql(src: str, col: str, nlags: int) -> str:
    return f"""c AS (SELECT series_id, {col} - avg({col}) OVER (PARTITION BY series_id) AS d,
        row_number() OVER ({PW}) AS pos FROM {src}),
den AS (SELECT series_id, sum(d * d) AS p0, count(d) AS n FROM c GROUP BY 1),
num AS (SELECT a.series_id, k.lag, sum(a.d * b.d) AS pk FROM c a CROSS JOIN range(1, {nlags + 1}) k(lag)
        JOIN c b ON a.series_id = b.series_id AND b.pos = a.pos - k.lag GROUP BY 1, 2),
acf AS (SELECT den.series_id, den.n, CAST(num.lag AS INTEGER) AS lag, pk / p0 AS acf FROM den
          JOIN num ON den.series_id = num.series_id
        UNION ALL SELECT series_id, n, 0, p0 / p0 FROM den)"""


@register("e2_acf", f"""WITH {DAILY_INTERP.replace("WITH ", "", 1)}, {acf_sql("filled", "y", 60)}
SELECT series_id, n, lag, round(acf, {R}) AS acf FROM acf""")
def e2_acf(spark, sf_dir):
    return out(S.acf(filled_daily(spark, sf_dir), "y", 60))


@register("e3_pacf")
def e3_pacf(spark, sf_dir):
    return out(S.pacf(S.acf(filled_daily(spark, sf_dir), "y", 60)))


@register("e4_difference", f"""WITH {O.DAILY},
d AS (SELECT series_id, ts, y, n_orders, y - lag(y) OVER ({PW}) AS y_diff FROM daily)
SELECT series_id, ts, round(y, {R}) AS y, n_orders, round(y_diff, {R}) AS y_diff FROM d WHERE y_diff IS NOT NULL""")
def e4_difference(spark, sf_dir):
    return out(S.difference(T.daily_grid(spark, sf_dir)))


@register("e5_stationarity")
def e5_stationarity(spark, sf_dir):
    return out(U.stationarity(T.daily_grid(spark, sf_dir), "y"))


@register("e5_kpss", f"""WITH {O.DAILY},
o AS (SELECT series_id, row_number() OVER ({PW}) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n,
        y - avg(y) OVER (PARTITION BY series_id) AS e FROM daily WHERE y IS NOT NULL),
r AS (SELECT series_id, n, sum(e) OVER (PARTITION BY series_id ORDER BY pos) AS run FROM o),
eta AS (SELECT series_id, n, sum(run * run) AS ss FROM r GROUP BY 1, 2),
acv AS (SELECT a.series_id, a.n, a.pos - b.pos AS k, sum(a.e * b.e) AS v FROM o a JOIN o b
          ON a.series_id = b.series_id AND b.pos <= a.pos AND b.pos >= a.pos - 100 GROUP BY 1, 2, 3),
s AS (SELECT series_id, n, sum(CASE WHEN k = 0 THEN v / n ELSE 2 * v / n END) AS s0, sum(2 * k * v / n) AS s1
      FROM acv WHERE k <= floor(pow(n, 2.0 / 9.0)) GROUP BY 1, 2),
l AS (SELECT series_id, n, CAST(least(floor(1.1447 * pow(pow(s1 / s0, 2), 1.0 / 3.0) * pow(n, 1.0 / 3.0)), n - 1) AS INTEGER) AS lags FROM s),
lr AS (SELECT l.series_id, l.lags, sum(CASE WHEN k = 0 THEN v ELSE 2 * v * (1 - k / (lags + 1.0::DOUBLE)) END) AS s
       FROM acv JOIN l ON acv.series_id = l.series_id WHERE k <= lags GROUP BY 1, 2)
SELECT lr.series_id, eta.n, round(eta.ss / (eta.n * lr.s), {R}) AS kpss_stat, lr.lags AS kpss_lags
FROM eta JOIN lr ON eta.series_id = lr.series_id""")
def e5_kpss(spark, sf_dir):
    return out(U.stationarity(T.daily_grid(spark, sf_dir), "y").select("series_id", "n", "kpss_stat", "kpss_lags"))


@register("e6_ljung_box", f"""WITH {DECOMP_SQL}, {acf_sql("dec", "resid", 48)},
s AS (SELECT series_id, n, {", ".join(f"sum(CASE WHEN lag BETWEEN 1 AND {K} THEN acf * acf / (n - lag) END) AS s{K}"
                                      for K in (24, 48))} FROM acf GROUP BY 1, 2)
SELECT series_id, 24 AS lag, round(n * (n + 2) * s24, {R}) AS lb_stat FROM s
UNION ALL SELECT series_id, 48, round(n * (n + 2) * s48, {R}) FROM s""")
def e6_ljung_box(spark, sf_dir):
    return out(S.ljung_box(S.acf(decomposed(spark, sf_dir), "resid", 48), (24, 48)).drop("lb_pvalue"))


@register("e6_ljung_box_pvalue")
def e6_ljung_box_pvalue(spark, sf_dir):
    return out(S.ljung_box(S.acf(decomposed(spark, sf_dir), "resid", 48), (24, 48)))


@register("e7_moments", f"""WITH {DECOMP_SQL},
m AS (SELECT series_id, avg(resid) AS mu, count(resid) AS n FROM dec GROUP BY 1),
c AS (SELECT d.series_id, avg(power(resid - mu, 2)) AS m2, avg(power(resid - mu, 3)) AS m3,
        avg(power(resid - mu, 4)) AS m4 FROM dec d JOIN m ON d.series_id = m.series_id GROUP BY 1)
SELECT c.series_id, round(m3 / power(m2, 1.5), {R}) AS skew, round(m4 / (m2 * m2), {R}) AS kurtosis, n
FROM c JOIN m ON c.series_id = m.series_id""")
def e7_moments(spark, sf_dir):
    return out(S.moments(decomposed(spark, sf_dir), "resid"))


# ---------------------------------------------------------------- anomalies
Z_SQL = f"""z AS (SELECT series_id, ts, y, (y - avg(y) OVER (PARTITION BY series_id))
            / nullif(stddev_samp(y) OVER (PARTITION BY series_id), 0) AS z FROM daily)"""
RZ_SQL = f"""rz AS (SELECT series_id, ts, resid, (resid - avg(resid) OVER (PARTITION BY series_id))
             / nullif(stddev_samp(resid) OVER (PARTITION BY series_id), 0) AS z FROM dec)"""
IQR_SQL = f"""iq AS (SELECT series_id, ts, y,
  CASE WHEN count(y) OVER w >= 10 THEN quantile_cont(y, 0.25) OVER w END AS q1,
  CASE WHEN count(y) OVER w >= 10 THEN quantile_cont(y, 0.75) OVER w END AS q3
  FROM daily WINDOW w AS ({PW} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""
FLAGS_SQL = f"""{O.DAILY}, {DECOMP_SQL.replace(O.DAILY + ",", "", 1) if DECOMP_SQL.startswith(O.DAILY) else DECOMP_SQL},
{Z_SQL}, {RZ_SQL}, {IQR_SQL},
cons AS (SELECT z.series_id, z.ts, coalesce(abs(z.z) > 3, false) AS zscore_flag,
    coalesce(abs(rz.z) > 3, false) AS resid_flag,
    coalesce(iq.y < iq.q1 - 1.5 * (iq.q3 - iq.q1) OR iq.y > iq.q3 + 1.5 * (iq.q3 - iq.q1), false) AS iqr_flag
  FROM z JOIN rz ON z.series_id = rz.series_id AND z.ts = rz.ts JOIN iq ON z.series_id = iq.series_id AND z.ts = iq.ts),
flagged AS (SELECT *, CAST(zscore_flag AS INTEGER) + CAST(resid_flag AS INTEGER) + CAST(iqr_flag AS INTEGER)
  AS n_methods_flagged FROM cons WHERE CAST(zscore_flag AS INTEGER) + CAST(resid_flag AS INTEGER)
  + CAST(iqr_flag AS INTEGER) >= 2)"""


@register("a1_zscore", f"""WITH {O.DAILY}, {Z_SQL}
SELECT series_id, ts, round(y, {R}) AS y, round(z, {R}) AS z, coalesce(abs(z) > 3, false) AS zscore_flag FROM z""")
def a1_zscore(spark, sf_dir):
    return out(A.zscore(T.daily_grid(spark, sf_dir)).select("series_id", "ts", "y", "z", "zscore_flag"))


@register("a2_resid_zscore", f"""WITH {DECOMP_SQL}, {RZ_SQL}
SELECT series_id, ts, round(resid, {R}) AS resid, round(z, {R}) AS z, coalesce(abs(z) > 3, false) AS resid_flag FROM rz""")
def a2_resid_zscore(spark, sf_dir):
    return out(A.residual_zscore(filled_daily(spark, sf_dir)).select("series_id", "ts", "resid", "z", "resid_flag"))


@register("a2_stl_zscore")
def a2_stl_zscore(spark, sf_dir):
    return out(A.residual_zscore(filled_daily(spark, sf_dir), method="stl").select("series_id", "ts", "resid", "z", "resid_flag"))


@register("a3_rolling_iqr", f"""WITH {O.DAILY}, {IQR_SQL}
SELECT series_id, ts, round(y, {R}) AS y, round(q1, {R}) AS q1, round(q3, {R}) AS q3,
  coalesce(y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1), false) AS iqr_flag FROM iq""")
def a3_rolling_iqr(spark, sf_dir):
    return out(A.rolling_iqr(T.daily_grid(spark, sf_dir)).select("series_id", "ts", "y", "q1", "q3", "iqr_flag"))


def consensus(spark, sf_dir):
    d = materialize(T.daily_grid(spark, sf_dir))  # feeds three detectors and the decomposition
    z = A.zscore(d)
    rz = A.residual_zscore(G.interpolate_position(d, ["y"], step="day"))
    iq = A.rolling_iqr(d)
    return A.consensus([z, rz, iq], ["zscore_flag", "resid_flag", "iqr_flag"])


@register("a4_isolation_forest")
def a4_isolation_forest(spark, sf_dir):
    cols = list(T.LINEITEM_MEASURES)
    z = FE.standardize(T.lineitem_daily(spark, sf_dir), cols)
    return out(A.isolation_forest(z, cols, 0.02, 100, 256, 42))


@register("a5_consensus", f"WITH {FLAGS_SQL} SELECT * FROM flagged")
def a5_consensus(spark, sf_dir):
    return consensus(spark, sf_dir)


@register("a5_consensus_forest")
def a5_consensus_forest(spark, sf_dir):
    """Four detectors: z-score, robust STL residual, rolling IQR and the isolation forest on
    the day's total and count; a flag column each, days that two or more flag."""
    d = materialize(T.daily_grid(spark, sf_dir))
    z = A.zscore(d)
    rz = A.residual_zscore(G.interpolate_position(d, ["y"], step="day"), method="stl")
    forest = A.isolation_forest(FE.standardize(d, ["y", "n_orders"]), ["y", "n_orders"], 0.02, 100, 256, 42)
    return A.consensus([z, rz, A.rolling_iqr(d), forest], ["zscore_flag", "resid_flag", "iqr_flag", "iforest_flag"])


@register("a6_known_gaps", f"""WITH {FLAGS_SQL},
known AS (SELECT DISTINCT series_id, ts AS day FROM daily WHERE y IS NULL)
SELECT f.*, (f.series_id, f.ts) IN (SELECT (series_id, day) FROM known) AS is_known_gap FROM flagged f""")
def a6_known_gaps(spark, sf_dir):
    d = T.daily_grid(spark, sf_dir)
    known = d.where(F.col("y").isNull()).select("series_id", F.col("ts").alias("day"))
    return A.split_known(consensus(spark, sf_dir), known)


@register("a7_calendar_context", f"""WITH {FLAGS_SQL}, {holiday_cte('daily')}
SELECT f.*, dayname(f.ts) AS weekday, CAST(month(f.ts) AS INTEGER) AS month,
  f.ts IN (SELECT day FROM hol) AS is_holiday FROM flagged f""")
def a7_calendar_context(spark, sf_dir):
    d = T.daily_grid(spark, sf_dir)
    return A.with_calendar(consensus(spark, sf_dir), P.holiday_calendar(P.years_of(d)))


@register("a8_flagged_detail", f"""WITH {FLAGS_SQL},
m AS (SELECT series_id, avg(y) AS overall_mean FROM daily GROUP BY 1)
SELECT d.series_id, d.ts, round(d.y, {R}) AS daily_mean, round(m.overall_mean, {R}) AS overall_mean,
  round(d.y - m.overall_mean, {R}) AS diff, CASE WHEN d.y - m.overall_mean > 0 THEN 'high' ELSE 'low' END AS direction
FROM daily d JOIN m ON d.series_id = m.series_id
WHERE (d.series_id, d.ts) IN (SELECT series_id, ts FROM flagged)""")
def a8_flagged_detail(spark, sf_dir):
    return out(A.flagged_detail(T.daily_grid(spark, sf_dir), consensus(spark, sf_dir)))
