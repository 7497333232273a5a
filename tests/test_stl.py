"""STL against a scalar version written straight from the published procedure."""
import datetime as dt
import random

import numpy as np
import pytest

from horizonkit.operators import anomaly as A
from horizonkit.operators.stl import Spans, stl

START = dt.datetime(2020, 1, 1)


def fit_at(x, y, w, lo, hi, span, n):
    """Local line at x through the points lo..hi of y; None without weight."""
    h = max(x - lo, hi - x) + (max(0, span - n) // 2)
    k = []
    for j in range(lo, hi + 1):
        r = abs(j - x)
        k.append(w[j] * (1.0 if r <= 0.001 * h else (1 - (r / h) ** 3) ** 3 if r <= 0.999 * h else 0.0))
    if sum(k) <= 0:
        return None
    k = [v / sum(k) for v in k]
    mean = sum(v * j for v, j in zip(k, range(lo, hi + 1)))
    var = sum(v * (j - mean) ** 2 for v, j in zip(k, range(lo, hi + 1)))
    if h > 0 and var ** 0.5 > 0.001 * (n - 1):
        k = [v * (1 + (x - mean) * (j - mean) / var) for v, j in zip(k, range(lo, hi + 1))]
    return sum(v * y[j] for v, j in zip(k, range(lo, hi + 1)))


def smooth(y, w, span):
    n, out = len(y), []
    for i in range(n):
        lo = 0 if span >= n else min(max(0, i - (span - 1) // 2), n - span)
        v = fit_at(i, y, w, lo, min(n, lo + span) - 1, span, n)
        out.append(y[i] if v is None else v)
    return out


def plain(y, s):
    n, p = len(y), s.period
    known = [v is not None for v in y]
    trend, weight = [0.0] * n, [1.0] * n
    for outer in range(s.outer + 1):
        w = [a if k else 0.0 for a, k in zip(weight, known)]
        for _ in range(s.inner):
            cycle = [0.0] * (n + 2 * p)
            for ph in range(p):
                sub = [y[t] - trend[t] if known[t] else 0.0 for t in range(ph, n, p)]
                sw = w[ph::p]
                mid = smooth(sub, sw, s.seasonal)
                m = len(sub)
                before = fit_at(-1, sub, sw, 0, min(s.seasonal, m) - 1, s.seasonal, m)
                after = fit_at(m, sub, sw, max(0, m - s.seasonal), m - 1, s.seasonal, m)
                whole = [mid[0] if before is None else before, *mid, mid[-1] if after is None else after]
                for c, v in enumerate(whole):
                    cycle[ph + c * p] = v
            mean = lambda v, k: [sum(v[i:i + k]) / k for i in range(len(v) - k + 1)]
            low = smooth(mean(mean(mean(cycle, p), p), 3), [1.0] * n, s.low_pass)
            seasonal = [cycle[p + t] - low[t] for t in range(n)]
            trend = smooth([y[t] - seasonal[t] if known[t] else trend[t] for t in range(n)], w, s.trend)
        if outer < s.outer:
            off = [abs(y[t] - trend[t] - seasonal[t]) if known[t] else None for t in range(n)]
            c = 6 * float(np.median([v for v in off if v is not None]))
            for t, v in enumerate(off):
                if v is not None:
                    weight[t] = 1.0 if v <= 0.001 * c else (1 - (v / c) ** 2) ** 2 if v <= 0.999 * c else 0.0
    return trend, seasonal, weight


def series(seed, n, p, gaps=0):
    r = random.Random(seed)
    y = [20 + 0.03 * t + 4 * np.sin(2 * np.pi * t / p) + 2 * ((t % p) == 3 % p) + r.gauss(0, 0.5) + (15 if r.random() < .03 else 0) for t in range(n)]
    for _ in range(gaps):
        y[r.randrange(1, n - 1)] = None
    return [None if v is None else float(v) for v in y]


def frame(spark, named):
    rows = [(k, START + dt.timedelta(days=t), v, "x") for k, y in named.items() for t, v in enumerate(y)]
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double, pos string")


def columns(df):
    out = {}
    for r in df.orderBy("series_id", "ts").collect():
        out.setdefault(r.series_id, []).append((r.trend, r.seasonal, r.weight, r.resid, r.y))
    return out


@pytest.mark.parametrize("period,options", [(7, {}), (12, {"robust": False}), (4, {"seasonal": 5, "outer": 3}), (7, {"trend": 41, "outer": 2})])
def test_equals_scalar_version_in_and_across_buckets(spark, period, options):
    s = Spans.of(period, **options)
    named = {"long": series(1, 700, period), "gaps": series(2, 400, period, 25), "short": series(3, 5 * period + 2, period)}
    whole = columns(stl(frame(spark, named), period=period, **options))
    parted = columns(stl(frame(spark, named), period=period, bucket_steps=s.halo(), **options)) if s.halo() < 300 else None
    for name, y in named.items():
        trend, seasonal, weight = plain(y, s)
        for got in filter(None, (whole[name], parted and parted[name])):
            assert np.allclose([v[0] for v in got], trend, atol=1e-7) and np.allclose([v[1] for v in got], seasonal, atol=1e-7)
            assert np.allclose([v[2] for v in got], weight, atol=1e-6)
            for (t, c, _, resid, v) in got:
                assert (resid is None) == (v is None) and (v is None or abs(resid - (v - t - c)) < 1e-12)


def test_buckets_change_nothing(spark):
    """Yearly period, several buckets of a long series against one."""
    named = {"y": series(5, 7000, 30), "z": series(6, 5000, 30, 60)}
    args = dict(period=30, outer=2)
    a = columns(stl(frame(spark, named), **args))
    b = columns(stl(frame(spark, named), bucket_steps=1200, **args))
    for name in named:
        assert np.allclose([v[:3] for v in a[name]], [v[:3] for v in b[name]], atol=1e-8)


def test_odd_series(spark):
    named = {"few": [1.0, 2.0, 3.0], "none": [None] * 40, "flat": [5.0] * 60}
    got = columns(stl(frame(spark, named), period=7))
    assert all(v[:4] == (None,) * 4 for v in got["few"] + got["none"])
    assert np.allclose([v[0] + v[1] for v in got["flat"]], 5.0)
    assert stl(frame(spark, {"empty": []}), period=7).collect() == []
    with pytest.raises(ValueError):
        stl(frame(spark, named), period=7, bucket_steps=10)


def test_feeds_residual_scores(spark):
    y = series(9, 400, 7)
    y[200] += 60
    flagged = A.residual_zscore(frame(spark, {"s": y}), method="stl").where("resid_flag").collect()
    assert START + dt.timedelta(days=200) in {r.ts for r in flagged}
