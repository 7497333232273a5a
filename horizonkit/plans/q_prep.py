"""Data preparation queries: gaps, interpolation, resampling, quality, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timecols import day_of, floor_ts
from ..operators import grid as G
from ..operators import profile as P
from ..operators import quality as V
from ..sources import tables as T
from . import oracle as O
from .registry import out, register

R = O.R
SEASON = "CASE WHEN month({c}) IN (12,1,2) THEN 'winter' WHEN month({c}) IN (3,4,5) THEN 'spring' " \
         "WHEN month({c}) IN (6,7,8) THEN 'summer' ELSE 'fall' END"

# ---------------------------------------------------------------- G1–G6
GAPS_SQL = f"""WITH {O.MINUTE_GRID},
f AS (SELECT series_id, ts, y IS NULL AS miss,
        row_number() OVER (PARTITION BY series_id ORDER BY ts)
        - row_number() OVER (PARTITION BY series_id, y IS NULL ORDER BY ts) AS grp
      FROM mgrid),
gaps AS (SELECT series_id, min(ts) AS "start", max(ts) AS "end", count(*) AS rows,
           date_diff('second', min(ts), max(ts)) + 60 AS duration_seconds
         FROM f WHERE miss GROUP BY series_id, grp)"""


@register("g1_gaps", GAPS_SQL + " SELECT * FROM gaps")
def g1_gaps(spark, sf_dir):
    return G.find_gaps(T.minute_grid(spark, sf_dir), ["y"], step="minute")


@register("g2_gap_summary", GAPS_SQL + f""",
tot AS (SELECT series_id, count(*) AS total_rows, count(*) FILTER (WHERE y IS NULL) AS missing_rows
        FROM mgrid GROUP BY 1),
gs AS (SELECT series_id, count(*) AS n_gaps, count(*) FILTER (WHERE duration_seconds > 10800) AS n_long_gaps,
         coalesce(sum(rows) FILTER (WHERE duration_seconds > 10800), 0) AS rows_in_long_gaps,
         max(duration_seconds) AS longest_gap_seconds FROM gaps GROUP BY 1)
SELECT t.series_id, total_rows, missing_rows, round(missing_rows * 100.0 / total_rows, {R}) AS missing_pct,
       coalesce(n_gaps, 0) AS n_gaps, coalesce(n_long_gaps, 0) AS n_long_gaps,
       CAST(coalesce(rows_in_long_gaps, 0) AS BIGINT) AS rows_in_long_gaps,
       round(coalesce(rows_in_long_gaps, 0) * 100.0 / nullif(missing_rows, 0), {R}) AS long_gap_share_pct,
       longest_gap_seconds
FROM tot t LEFT JOIN gs ON t.series_id = gs.series_id""")
def g2_gap_summary(spark, sf_dir):
    mg = T.minute_grid(spark, sf_dir)
    return out(G.gap_summary(mg, G.find_gaps(mg, ["y"], step="minute"), ["y"], threshold_seconds=3 * 3600))


INTERP_SQL = f"""WITH {O.MINUTE_GRID},
p AS (SELECT series_id, ts, y, n_events, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos,
        date_diff('second', TIMESTAMP '1970-01-01', ts) AS s FROM mgrid),
q AS (SELECT *,
  last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ppos,
  last_value(CASE WHEN y IS NOT NULL THEN s END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ps,
  last_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS npos,
  first_value(CASE WHEN y IS NOT NULL THEN s END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ns,
  first_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM p)"""


@register("g3_interpolate_time", INTERP_SQL + f"""
SELECT series_id, ts, round(CASE WHEN y IS NOT NULL THEN y
  WHEN ppos IS NOT NULL AND npos IS NOT NULL AND pos - ppos <= 180
  THEN pv + (nv - pv) * ((s - ps) * 1.0 / (ns - ps)) END, {R}) AS y, n_events
FROM q""")
def g3_interpolate_time(spark, sf_dir):
    return out(G.interpolate_time(T.minute_grid(spark, sf_dir), ["y"], step="minute", limit=180))


DAILY_INTERP = f"""WITH {O.DAILY},
p AS (SELECT series_id, ts, y, n_orders, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos FROM daily),
q AS (SELECT *,
  last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ppos,
  last_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS npos,
  first_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM p),
filled AS (SELECT series_id, ts, n_orders, coalesce(y, CASE WHEN ppos IS NOT NULL AND npos IS NOT NULL
  THEN pv + (nv - pv) * ((pos - ppos) * 1.0 / (npos - ppos)) END, pv, nv) AS y FROM q)"""


@register("g4_interpolate_position", DAILY_INTERP + f" SELECT series_id, ts, round(y, {R}) AS y, n_orders FROM filled")
def g4_interpolate_position(spark, sf_dir):
    return out(G.interpolate_position(T.daily_grid(spark, sf_dir), ["y"], step="day"))


@register("g5_daily_grid", f"WITH {O.DAILY} SELECT series_id, ts, round(y, {R}) AS y, n_orders FROM daily")
def g5_daily_grid(spark, sf_dir):
    return out(T.daily_grid(spark, sf_dir))


@register("g6_align", f"""WITH daily_raw AS (
  SELECT o_orderpriority AS series_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ts, sum(o_totalprice) AS y
  FROM orders GROUP BY 1, 2),
want AS (SELECT DISTINCT o.o_orderpriority AS series_id, CAST(CAST(l.l_shipdate AS DATE) AS TIMESTAMP) AS ts
         FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT w.series_id, w.ts, round(d.y, {R}) AS y FROM want w LEFT JOIN daily_raw d
  ON w.series_id = d.series_id AND w.ts = d.ts""")
def g6_align(spark, sf_dir):
    """Daily order totals re-indexed to the ship days of each priority's lines."""
    li = T.read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    o = T.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    want = (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_orderpriority").alias("series_id"), day_of("l_shipdate").alias("ts")).distinct())
    return out(G.align(T.daily_series(spark, sf_dir).select("series_id", "ts", "y"), want))


# ---------------------------------------------------------------- R1–R9
@register("r1_daily_resample", f"""WITH {O.MINUTE},
dr AS (SELECT series_id, date_trunc('day', ts) AS ts, avg(y) AS y, CAST(sum(n_events) AS BIGINT) AS n_events
       FROM minute GROUP BY 1, 2),
b AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM dr GROUP BY 1),
i AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b)
SELECT i.series_id, i.ts, round(dr.y, {R}) AS y, dr.n_events FROM i LEFT JOIN dr
  ON i.series_id = dr.series_id AND i.ts = dr.ts""")
def r1_daily_resample(spark, sf_dir):
    return out(G.resample(T.minute_series(spark, sf_dir), step="day", mean_cols=["y"], sum_cols=["n_events"]))


@register("r2_hour_to_day", f"""WITH {O.HOURLY},
dr AS (SELECT series_id, date_trunc('day', ts) AS ts, avg(y) AS y FROM hourly GROUP BY 1, 2)
SELECT series_id, ts, round(y, {R}) AS y FROM dr""")
def r2_hour_to_day(spark, sf_dir):
    return out(G.resample(T.hourly_grid(spark, sf_dir).select("series_id", "ts", "y"), step="day", mean_cols=["y"]))


@register("r3_hourly_profile", f"""WITH {O.HOURLY}
SELECT series_id, CAST(hour(ts) AS INTEGER) AS hour,
  round(avg(CASE WHEN isodow(ts) < 6 THEN y END), {R}) AS weekday_mean,
  round(avg(CASE WHEN isodow(ts) >= 6 THEN y END), {R}) AS weekend_mean
FROM hourly GROUP BY 1, 2""")
def r3_hourly_profile(spark, sf_dir):
    return out(P.hourly_profile(T.hourly_grid(spark, sf_dir), keys=["series_id"]))


@register("r4_month_year", f"""WITH {O.DAILY}
SELECT series_id, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year, round(avg(y), {R}) AS mean
FROM daily GROUP BY 1, 2, 3""")
def r4_month_year(spark, sf_dir):
    return out(P.month_year(T.daily_grid(spark, sf_dir), keys=["series_id"]))


@register("r5_box_weekday", f"""WITH {O.DAILY},
x AS (SELECT series_id, CAST(isodow(ts) - 1 AS INTEGER) AS "group", y FROM daily WHERE y IS NOT NULL),
q AS (SELECT series_id, "group", quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median,
        quantile_cont(y, 0.75) AS q3, count(*) AS n FROM x GROUP BY 1, 2)
SELECT q.series_id, q."group", round(q1, {R}) AS q1, round(median, {R}) AS median, round(q3, {R}) AS q3,
  round(q3 - q1, {R}) AS iqr, n,
  round(min(CASE WHEN y >= q1 - 1.5 * (q3 - q1) AND y <= q3 + 1.5 * (q3 - q1) THEN y END), {R}) AS whisker_lo,
  round(max(CASE WHEN y >= q1 - 1.5 * (q3 - q1) AND y <= q3 + 1.5 * (q3 - q1) THEN y END), {R}) AS whisker_hi,
  count(*) FILTER (WHERE NOT (y >= q1 - 1.5 * (q3 - q1) AND y <= q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM x JOIN q ON x.series_id = q.series_id AND x."group" = q."group"
GROUP BY q.series_id, q."group", q1, median, q3, n""")
def r5_box_weekday(spark, sf_dir):
    return out(P.box_stats(T.daily_grid(spark, sf_dir), F.weekday("ts"), keys=["series_id"]))


def _easter_sql(y: str) -> str:
    a, b, c = f"({y} % 19)", f"({y} // 100)", f"({y} % 100)"
    d, e = f"({b} // 4)", f"({b} % 4)"
    f_ = f"(({b} + 8) // 25)"
    g = f"(({b} - {f_} + 1) // 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i, k = f"({c} // 4)", f"({c} % 4)"
    l_ = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {l_}) // 451)"
    return (f"make_date(CAST({y} AS BIGINT), CAST(({h} + {l_} - 7 * {m} + 114) // 31 AS BIGINT), "
            f"CAST(({h} + {l_} - 7 * {m} + 114) % 31 + 1 AS BIGINT))")


def holiday_cte(src: str) -> str:
    fixed = " UNION ALL ".join(
        f"SELECT make_date(yr, {m}, {d}) AS d, '{n}' AS holiday FROM yrs" for m, d, n in P.FIXED_HOLIDAYS)
    mov = " UNION ALL ".join(
        f"SELECT {_easter_sql('yr')} + INTERVAL {off} DAY AS d, '{n}' AS holiday FROM yrs"
        for off, n in P.EASTER_OFFSETS)
    return f"""yrs AS (SELECT unnest(generate_series(year(min(ts)), year(max(ts)))) AS yr FROM {src}),
hol AS (SELECT CAST(d AS TIMESTAMP) AS day, holiday FROM ({fixed} UNION ALL {mov}) h)"""


@register("a9_holiday_calendar", f"WITH {O.DAILY}, {holiday_cte('daily')} SELECT * FROM hol")
def a9_holiday_calendar(spark, sf_dir):
    return P.holiday_calendar(P.years_of(T.daily_grid(spark, sf_dir)))


@register("r6_holiday_effect", f"""WITH {O.DAILY}, {holiday_cte('daily')}
SELECT series_id, (ts IN (SELECT day FROM hol)) AS is_holiday, round(avg(y), {R}) AS mean,
  round(median(y), {R}) AS median, count(y) AS n
FROM daily GROUP BY 1, 2""")
def r6_holiday_effect(spark, sf_dir):
    d = T.daily_grid(spark, sf_dir)
    return out(P.holiday_effect(d, P.holiday_calendar(P.years_of(d)), keys=["series_id"]))


LI_COLS = list(T.LINEITEM_MEASURES)


@register("r7_corr_matrix", f"WITH {O.LINEITEM_DAILY} " + " UNION ALL ".join(
    f"SELECT 'all' AS series_id, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), {R}) AS corr FROM li_daily"
    for i, a in enumerate(LI_COLS) for b in LI_COLS[i + 1:]))
def r7_corr_matrix(spark, sf_dir):
    return out(P.corr_matrix(T.lineitem_daily(spark, sf_dir), LI_COLS, keys=["series_id"]))


@register("r8_trailing_mean", f"""WITH {O.DAILY}
SELECT series_id, ts, round(y, {R}) AS y, n_orders, round(CASE WHEN count(y) OVER w >= 1 THEN avg(y) OVER w END, {R})
  AS y_mean_30
FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def r8_trailing_mean(spark, sf_dir):
    return out(P.trailing_mean(T.daily_grid(spark, sf_dir), n=30, min_periods=1))


@register("r9_rolling_quantile", f"""WITH {O.DAILY}
SELECT series_id, ts, round(y, {R}) AS y, n_orders,
  round(CASE WHEN count(y) OVER w >= 10 THEN quantile_cont(y, 0.25) OVER w END, {R}) AS y_q25,
  round(CASE WHEN count(y) OVER w >= 10 THEN quantile_cont(y, 0.75) OVER w END, {R}) AS y_q75
FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def r9_rolling_quantile(spark, sf_dir):
    return out(P.rolling_quantiles(T.daily_grid(spark, sf_dir), n=30, min_periods=10))


# ---------------------------------------------------------------- V1–V6
# The validation rule set applied to the raw events table.
EVENT_RULES = [V.Rule("ts_not_null", "ts", "not_null"), V.Rule("type_not_null", "event_type", "not_null"),
               V.Rule("value_non_negative", "value", "ge", lo=0.0),
               V.Rule("value_in_range", "value", "between", lo=0.0, hi=400.0),
               V.Rule("user_non_negative", "user_id", "ge", lo=0.0)]


def _rule_sql(r: V.Rule) -> str:
    c = r.column
    return {"not_null": f"{c} IS NOT NULL", "ge": f"({c} IS NULL OR {c} >= {r.lo})",
            "le": f"({c} IS NULL OR {c} <= {r.hi})",
            "between": f"({c} IS NULL OR {c} BETWEEN {r.lo} AND {r.hi})"}[r.check]


@register("v1_validate", " UNION ALL ".join(
    f"SELECT '{r.rule_id}' AS rule_id, '{r.column}' AS \"column\", '{r.check}' AS \"check\", "
    f"count(*) FILTER (WHERE NOT {_rule_sql(r)}) AS n_failed FROM events" for r in EVENT_RULES))
def v1_validate(spark, sf_dir):
    return V.validate(T.read_table(spark, sf_dir, "events"), EVENT_RULES)


@register("v1_violations", " UNION ALL ".join(
    f"SELECT event_id, '{r.rule_id}' AS rule_id FROM events WHERE NOT {_rule_sql(r)}" for r in EVENT_RULES))
def v1_violations(spark, sf_dir):
    return V.violations(T.read_table(spark, sf_dir, "events"), EVENT_RULES, ["event_id"])


@register("v2_missing_pct", f"""WITH {O.MINUTE_GRID}
SELECT * FROM (SELECT 'y' AS "column", round(avg(CAST(y IS NULL AS DOUBLE)) * 100, {R}) AS missing_pct FROM mgrid
  UNION ALL SELECT 'n_events', round(avg(CAST(n_events IS NULL AS DOUBLE)) * 100, {R}) FROM mgrid) t
WHERE missing_pct > 0""")
def v2_missing_pct(spark, sf_dir):
    return out(V.missing_pct(T.minute_grid(spark, sf_dir), ["y", "n_events"]))


@register("v3_duplicate_ts", """SELECT event_type AS series_id, count(*) - count(DISTINCT date_trunc('minute', ts))
  AS duplicate_ts FROM events GROUP BY 1""")
def v3_duplicate_ts(spark, sf_dir):
    ev = T.read_table(spark, sf_dir, "events").select(F.col("event_type").alias("series_id"),
                                                      floor_ts("ts", "minute").alias("ts"))
    return V.duplicate_ts(ev)


@register("v4_describe", f"""SELECT event_type, 'value' AS "column", count(value) AS count, round(avg(value), {R}) AS mean,
  round(stddev_samp(value), {R}) AS std, round(min(value), {R}) AS min, round(quantile_cont(value, 0.25), {R}) AS p25,
  round(quantile_cont(value, 0.5), {R}) AS p50, round(quantile_cont(value, 0.75), {R}) AS p75,
  round(max(value), {R}) AS max FROM events GROUP BY 1""")
def v4_describe(spark, sf_dir):
    return out(V.describe_exact(T.read_table(spark, sf_dir, "events"), ["value"], keys=["event_type"]))


@register("v5_missing_rows", f"WITH {O.DAILY} SELECT series_id, ts, y, n_orders FROM daily WHERE y IS NULL")
def v5_missing_rows(spark, sf_dir):
    return V.missing_rows(T.daily_grid(spark, sf_dir), ["y"])


@register("r4_month_year_matrix", f"""WITH {O.DAILY}, m AS (
  SELECT series_id, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS VARCHAR) AS year,
         round(avg(y), {R}) AS mean FROM daily GROUP BY 1, 2, 3)
SELECT series_id, month, {", ".join(f"max(CASE WHEN year = '{y}' THEN mean END) AS " + '"' + str(y) + '"' for y in range(1995, 2002))} FROM m GROUP BY 1, 2""")
def r4_month_year_matrix(spark, sf_dir):
    """Month × year mean matrix (one column per year present in the data)."""
    d = T.daily_grid(spark, sf_dir)
    m = d.select("series_id", F.month("ts").alias("month"), F.year("ts").cast("string").alias("year"), "y")
    return out(m.groupBy("series_id", "month").pivot("year").agg(F.avg("y")))


@register("g2_top_gaps", GAPS_SQL + """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY series_id ORDER BY duration_seconds DESC, "start")
  AS INTEGER) AS rank FROM gaps) t WHERE rank <= 10""")
def g2_top_gaps(spark, sf_dir):
    """The ten longest gaps of each series (ties by start)."""
    return G.top_gaps(G.find_gaps(T.minute_grid(spark, sf_dir), ["y"], step="minute"), 10)
