"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Shared CTEs mirror ``sources.tables`` exactly. Doubles are rounded to 6
digits on both sides of every comparison.
"""

from __future__ import annotations

R = 6  # rounding digits at the edge of comparison queries

MINUTE = """minute AS (
  SELECT event_type AS series_id, date_trunc('minute', ts) AS ts, avg(value) AS y, count(*) AS n_events
  FROM events GROUP BY 1, 2)"""

HOURLY = MINUTE + """,
hourly_raw AS (
  SELECT series_id, date_trunc('hour', ts) AS ts, avg(y) AS y, CAST(sum(n_events) AS BIGINT) AS n_events
  FROM minute GROUP BY 1, 2),
hb AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM hourly_raw GROUP BY 1),
hidx AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM hb),
hourly AS (SELECT i.series_id, i.ts, r.y, r.n_events FROM hidx i LEFT JOIN hourly_raw r
           ON i.series_id = r.series_id AND i.ts = r.ts)"""

MINUTE_GRID = MINUTE + """,
mb AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM minute GROUP BY 1),
midx AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS ts FROM mb),
mgrid AS (SELECT i.series_id, i.ts, m.y, m.n_events FROM midx i LEFT JOIN minute m
          ON i.series_id = m.series_id AND i.ts = m.ts)"""

DAILY = """daily_raw AS (
  SELECT o_orderpriority AS series_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ts,
         sum(o_totalprice) AS y, count(*) AS n_orders
  FROM orders GROUP BY 1, 2),
dbnd AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM daily_raw GROUP BY 1),
didx AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM dbnd),
daily AS (SELECT i.series_id, i.ts, r.y, r.n_orders FROM didx i LEFT JOIN daily_raw r
          ON i.series_id = r.series_id AND i.ts = r.ts)"""

LINEITEM_DAILY = """li_raw AS (
  SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ts, sum(l_quantity) AS quantity,
         sum(l_extendedprice * (1 - l_discount)) AS revenue, avg(l_discount) AS discount, avg(l_tax) AS tax,
         CAST(count(*) AS DOUBLE) AS n_lines
  FROM lineitem GROUP BY 1),
lib AS (SELECT min(ts) AS lo, max(ts) AS hi FROM li_raw),
liidx AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM lib),
li_daily AS (SELECT 'all' AS series_id, i.ts, r.quantity, r.revenue, r.discount, r.tax, r.n_lines
             FROM liidx i LEFT JOIN li_raw r ON i.ts = r.ts)"""


def split_cte(frac: float = 0.2, grid: str = "hourly", name: str = "split", unit: str = "HOUR") -> str:
    keep = repr(1.0 - frac)
    return f"""{name} AS (
  SELECT series_id, lo AS series_start, hi AS series_end,
         date_trunc('day', lo + INTERVAL 1 {unit} * CAST(floor((date_diff('{unit.lower()}', lo, hi) + 1)
                    * CAST({keep} AS DOUBLE)) AS BIGINT)) AS test_start
  FROM (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM {grid} GROUP BY 1) b)"""


def origins_cte(horizon: int = 24, every: int = 24, split: str = "split", name: str = "origins",
                unit: str = "HOUR") -> str:
    return f"""{name} AS (
  SELECT series_id, unnest(generate_series(test_start, series_end - INTERVAL {horizon} {unit},
                                           INTERVAL {every} {unit})) AS origin
  FROM {split} WHERE test_start <= series_end - INTERVAL {horizon} {unit})"""


# (name, offset-of-step-h SQL, lo offset, hi offset) with H substituted
def _lookup_methods(horizon: int):
    return [
        ("naive", "0", 0, 0),
        ("daily_naive", "h - 24", 1 - 24, horizon - 24),
        ("weekly_naive", "h - 168", 1 - 168, horizon - 168),
        ("daily_profile", "((h - 1) % 24) - 23", -23, 0),
    ]


def backtest_cte(horizon: int = 24, methods=("naive", "daily_naive", "weekly_naive"), grid: str = "hourly",
                 origins: str = "origins", name: str = "bt") -> str:
    parts = []
    for m, off, lo, hi in _lookup_methods(horizon):
        if m not in methods:
            continue
        parts.append(f"""SELECT o.series_id, o.origin, CAST(s.h AS INTEGER) AS horizon_step, '{m}' AS method,
         o.origin + INTERVAL 1 HOUR * ({off.replace('h', 's.h')}) AS lk
  FROM {origins} o JOIN (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM {grid} GROUP BY 1) b
    ON o.series_id = b.series_id
  CROSS JOIN (SELECT range AS h FROM range(1, {horizon + 1})) s
  WHERE o.origin + INTERVAL ({lo}) HOUR >= b.lo AND o.origin + INTERVAL ({hi}) HOUR <= b.hi""")
    look = "\n  UNION ALL\n  ".join(parts)
    return f"""{name}_look AS (
  {look}),
{name} AS (
  SELECT l.series_id, l.origin, l.horizon_step, l.method, a.y AS actual, f.y AS forecast
  FROM {name}_look l
  LEFT JOIN {grid} f ON f.series_id = l.series_id AND f.ts = l.lk
  LEFT JOIN {grid} a ON a.series_id = l.series_id AND a.ts = l.origin + INTERVAL 1 HOUR * l.horizon_step)"""


def metric_sql(a: str = "actual", f: str = "forecast") -> str:
    ok = f"{a} IS NOT NULL AND {f} IS NOT NULL"
    return (f"round(avg(CASE WHEN {ok} THEN abs({a} - {f}) END), {R}) AS MAE, "
            f"round(sqrt(avg(CASE WHEN {ok} THEN ({a} - {f}) * ({a} - {f}) END)), {R}) AS RMSE, "
            f"round(avg(CASE WHEN {ok} THEN abs(({a} - {f}) / nullif({a}, 0)) END) * 100, {R}) AS MAPE, "
            f"round(avg(CASE WHEN {ok} THEN 2 * abs({a} - {f}) / nullif(abs({a}) + abs({f}), 0) END) * 100, {R}) "
            f"AS sMAPE, count(CASE WHEN {ok} THEN 1 END) AS n")


BT24 = ",\n".join([HOURLY, split_cte(0.2), origins_cte(24, 24),
                   backtest_cte(24, ("naive", "daily_naive", "weekly_naive", "daily_profile"))])
