"""Seasonal ARMA search: planted orders, the same regressions in numpy, any bucket size, forecasts."""
import datetime as dt

import numpy as np
import pytest

from horizonkit.operators import arma as AR

START = dt.datetime(2020, 1, 1)
M = 6


def simulate(seed, n, ar, ma):
    """Levels whose differences follow the given {lag: coefficient}."""
    r = np.random.default_rng(seed)
    e, z = r.normal(size=n + 200), np.zeros(n + 200)
    for t in range(30, n + 200):
        z[t] = 0.02 + sum(c * z[t - k] for k, c in ar.items()) + e[t] + sum(c * e[t - k] for k, c in ma.items())
    return 50 + np.cumsum(z[200:])


PLANTED = {"ar1": ({1: 0.6}, {}, (1, 0, 0, 0)), "ma1": ({}, {1: 0.7}, (0, 1, 0, 0)), "sar": ({M: 0.6}, {}, (0, 0, 1, 0)),
           "sma": ({}, {M: 0.7}, (0, 0, 0, 1)), "mixed": ({1: 0.7}, {1: 0.5}, (1, 1, 0, 0))}


@pytest.fixture(scope="module")
def levels():
    return {k: simulate(i, 3000, *v[:2]) for i, (k, v) in enumerate(PLANTED.items())}


@pytest.fixture(scope="module")
def frame(spark, levels):
    rows = [(k, START + dt.timedelta(hours=t), float(v)) for k, y in levels.items() for t, v in enumerate(y) if not (k == "ar1" and t in (700, 1500))]
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")


def plain(y, p, q, P, Q, bounds=(2, 2, 1, 1)):
    """Two regressions on the common sample, written out."""
    z = np.diff(y)
    lag = lambda x, k: np.concatenate([np.full(k, np.nan), x[:-k]])
    long = AR.long_lags(M, max(AR.lags_of(bounds[0], bounds[2], M) + AR.lags_of(bounds[1], bounds[3], M)))
    x = np.column_stack([np.ones(len(z)), *(lag(z, k) for k in long)])
    ok = np.isfinite(x).all(axis=1) & np.isfinite(z)
    e = z - x @ np.linalg.lstsq(x[ok], z[ok], rcond=None)[0]
    whole = np.column_stack([*(lag(z, k) for k in AR.lags_of(bounds[0], bounds[2], M)), *(lag(e, k) for k in AR.lags_of(bounds[1], bounds[3], M))])
    ok = np.isfinite(whole).all(axis=1) & np.isfinite(z)
    x = np.column_stack([np.ones(len(z)), *(lag(z, k) for k in AR.lags_of(p, P, M)), *(lag(e, k) for k in AR.lags_of(q, Q, M))])[ok]
    beta = np.linalg.lstsq(x, z[ok], rcond=None)[0]
    return beta, ((z[ok] - x @ beta) ** 2).sum(), ok.sum()


def test_every_order_equals_plain_regression(frame, levels):
    out = AR.search_arma(frame.where("series_id in ('ma1', 'ar1')"), 2, 2, 1, 1, M, trace=True).collect()
    assert len(out) == 2 * 3 * 3 * 2 * 2
    gapped = levels["ar1"].copy()
    gapped[[700, 1500]] = np.nan
    for r in out:
        y = levels["ma1"] if r.series_id == "ma1" else gapped
        beta, rss, n = plain(y, *(r[o] for o in AR.ORDER))
        assert r.n == n and r.rss == pytest.approx(rss, rel=1e-8) and np.allclose(r.coef, beta, atol=1e-6)
        assert r.aic == pytest.approx(n * np.log(rss / n) + 2 * (len(beta) + 1), rel=1e-9)


@pytest.mark.parametrize("bucket", [None, 100])
def test_finds_planted_orders_for_any_bucket(frame, bucket):
    got = {r.series_id: r for r in AR.search_arma(frame, 2, 2, 1, 1, M, "bic", bucket_steps=bucket).collect()}
    for k, (ar, ma, order) in PLANTED.items():
        assert tuple(got[k][o] for o in AR.ORDER) == order, k
        at = dict(zip([("ar", x) for x in got[k].ar_lags] + [("ma", x) for x in got[k].ma_lags], got[k].coef[1:]))
        for (kind, lag), c in at.items():
            assert c == pytest.approx((ar if kind == "ar" else ma).get(lag, 0.0), abs=0.09)


def test_short_and_empty_series(spark):
    rows = [("s", START + dt.timedelta(hours=t), float(t % 3)) for t in range(20)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    assert AR.search_arma(df, 1, 1, 1, 1, M).collect() == []
    assert AR.search_arma(df.limit(0), 1, 1, 1, 1, M).collect() == []


def test_forecasts_follow_the_recursion(spark, frame, levels):
    fit = AR.search_arma(frame.where("series_id in ('mixed', 'ar1')"), 1, 1, 1, 0, M)
    at = [START + dt.timedelta(hours=h) for h in (400, 705, 2000, 2999, 5)]
    origins = spark.createDataFrame([(k, t) for k in ("mixed", "ar1") for t in at], "series_id string, origin timestamp_ntz")
    got = {}
    for r in AR.arma_backtest(frame, fit, origins, 8).orderBy("origin", "horizon_step").collect():
        got.setdefault((r.series_id, r.origin), []).append(r.forecast)
    assert set(got) == {("mixed", t) for t in at[:4]} | {("ar1", at[0]), ("ar1", at[2]), ("ar1", at[3])}  # gaps and starts give none
    model = {r.series_id: r for r in fit.collect()}
    for (k, t), f in got.items():
        m, y = model[k], levels[k][:int((t - START).total_seconds() // 3600) + 1]
        z = list(np.diff(y))
        long = m.long_lags
        e = [0.0] * len(z)
        for i in range(len(z) - M - 2, len(z)):
            e[i] = z[i] - m.long_coef[0] - sum(c * z[i - g] for c, g in zip(m.long_coef[1:], long))
        level = y[-1]
        for h in range(8):
            c = m.coef
            z.append(c[0] + sum(b * z[len(z) - g] for b, g in zip(c[1:], m.ar_lags)) + sum(b * e[len(e) - g] for b, g in zip(c[1 + len(m.ar_lags):], m.ma_lags)))
            e.append(0.0)
            level += z[-1]
            assert f[h] == pytest.approx(level, rel=1e-9)
    assert {len(f) for f in got.values()} == {8}
