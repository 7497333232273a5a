"""ADF and KPSS against regressions written out with numpy, on series with gaps."""
import datetime as dt

import numpy as np
import pytest

from horizonkit.operators.unit_root import adf_pvalue, longest_lag, stationarity

START = dt.datetime(2020, 1, 1)


def fit(y, x):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rss = ((y - x @ beta) ** 2).sum()
    return beta, rss


def design(y, k, first):
    d = np.diff(y)
    t = np.arange(first, len(y))
    return d[t - 1], np.column_stack([np.ones(len(t)), y[t - 1], *(d[t - 1 - i] for i in range(1, k + 1))])


def plain_adf(y):
    p, best = longest_lag(len(y)), None
    for k in range(p + 1):
        d, x = design(y, k, p + 1)
        _, rss = fit(d, x)
        aic = len(d) * np.log(rss / len(d)) + 2 * x.shape[1]
        best = min(best, (aic, k)) if best else (aic, k)
    d, x = design(y, best[1], best[1] + 1)
    beta, rss = fit(d, x)
    return beta[1] / np.sqrt(rss / (len(d) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1]), best[1]


def plain_kpss(y):
    n, e = len(y), y - y.mean()
    s0, s1 = (e @ e) / n, 0.0
    for k in range(1, int(n ** (2 / 9)) + 1):
        c = (e[k:] @ e[:-k]) / (n / 2)
        s0, s1 = s0 + c, s1 + k * c
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    lrv = e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
    return (np.cumsum(e) ** 2).sum() / (n * lrv), lags


def make(seed, n, phi, season=0.0):
    r = np.random.default_rng(seed)
    y = np.zeros(n)
    for t in range(1, n):
        y[t] = phi * y[t - 1] + r.normal()
    return 100 + y + season * np.sin(np.arange(n) / 3)


@pytest.fixture(scope="module")
def named():
    return {"walk": make(1, 900, 1.0), "mean": make(2, 1200, 0.5), "season": make(3, 700, 0.9, 5.0), "short": make(4, 30, 0.3)}


@pytest.fixture(scope="module")
def frame(spark, named):
    r = np.random.default_rng(7)
    rows = []
    for k, y in named.items():
        t = 0
        for v in y:
            while r.random() < .25:  # missing steps: some rows are there with null, some are not
                if r.random() < .5:
                    rows.append((k, 1, START + dt.timedelta(days=t), None))
                t += 1
            rows.append((k, 1, START + dt.timedelta(days=t), float(v)))
            t += 1
    return spark.createDataFrame(rows, "series_id string, site int, ts timestamp_ntz, y double")


@pytest.mark.parametrize("bucket", [None, 60, 333])
def test_equals_plain_version_for_any_bucket(frame, named, bucket):
    out = stationarity(frame, keys=("series_id", "site"), bucket_rows=bucket)
    assert dict(out.dtypes)["site"] == "int"
    got = {r.series_id: r for r in out.collect()}
    assert set(got) == set(named)
    for k, y in named.items():
        stat, lags = plain_adf(y)
        assert got[k].n == len(y) and got[k].adf_lags == lags and got[k].adf_stat == pytest.approx(stat, rel=1e-8)
        stat, lags = plain_kpss(y)
        assert got[k].kpss_lags == lags and got[k].kpss_stat == pytest.approx(stat, rel=1e-9)
    assert not got["walk"].adf_stationary and not got["walk"].kpss_stationary
    assert got["mean"].adf_stationary and got["mean"].kpss_stationary


def test_published_p_values():
    """Critical values of the constant-only statistic (asymptotic)."""
    for stat, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert adf_pvalue(stat) == pytest.approx(p, abs=0.002)
    assert adf_pvalue(3.0) == 1.0 and adf_pvalue(-30.0) == 0.0
    assert abs(adf_pvalue(-1.6099) - adf_pvalue(-1.6101)) < 0.01


def test_odd_series(spark):
    day = lambda i: START + dt.timedelta(days=i)
    rows = [("one", day(0), 1.0), ("none", day(0), None), ("two", day(0), 1.0), ("two", day(1), 3.0)]
    rows += [("flat", day(i), 4.0) for i in range(50)] + [("line", day(i), float(i)) for i in range(50)]
    got = {r.series_id: r for r in stationarity(spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")).collect()}
    assert set(got) == {"one", "two", "flat", "line"}
    assert got["flat"].kpss_stat is None and got["flat"].adf_stat is None
    assert all(got[k].adf_stat is None and not got[k].adf_stationary for k in got)
    assert stationarity(spark.createDataFrame([], "series_id string, ts timestamp_ntz, y double")).collect() == []
