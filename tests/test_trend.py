"""Trend with chosen changepoints: planted breaks, optimality of the fit, buckets, intervals."""
import datetime as dt

import numpy as np
import pytest

from horizonkit.operators import trend as TR

START = dt.datetime(2019, 1, 1)


def values(seed, n, breaks, noise=0.5, step_hours=6):
    """``breaks``: {day: change of slope per day}."""
    r = np.random.default_rng(seed)
    d = np.arange(n) * step_hours / 24
    y = 30 + 0.05 * d + sum(v * np.maximum(d - at, 0) for at, v in breaks.items())
    return d, y + 4 * np.sin(2 * np.pi * d / 365.25) + 2 * np.cos(2 * np.pi * d / 7) + 1.5 * np.sin(2 * np.pi * d) + r.normal(scale=noise, size=n)


@pytest.fixture(scope="module")
def named():
    return {"two": values(1, 4000, {260: 0.2, 520: -0.35}), "none": values(2, 4000, {}), "gaps": values(3, 3000, {200: -0.3})}


@pytest.fixture(scope="module")
def frame(spark, named):
    r = np.random.default_rng(5)
    rows = []
    for k, (d, y) in named.items():
        for t, v in zip(d, y):
            if k != "gaps" or r.random() < .6:
                rows.append((k, 3, START + dt.timedelta(days=float(t)), float(v) if k != "gaps" or r.random() < .9 else None))
    return spark.createDataFrame(rows, "series_id string, site int, ts timestamp_ntz, y double")


def test_finds_planted_breaks(frame, named):
    fit, design = TR.fit_trend(frame, keys=("series_id", "site"), slope_scale=0.005)
    got = {r.series_id: r for r in fit.collect()}
    assert set(got) == set(named) and dict(fit.dtypes)["site"] == "int"
    day = lambda at: (dt.datetime(1970, 1, 1) + dt.timedelta(seconds=at) - START).total_seconds() / 86400
    for k, want in (("two", {260: 0.2, 520: -0.35}), ("gaps", {200: -0.3}), ("none", {})):
        found = [(day(c["at"]), c["per_day"]) for c in got[k].changes]
        for at, v in want.items():  # all of the change lies within one candidate distance of the break
            near = sum(c for t, c in found if abs(t - at) <= 45)
            assert near == pytest.approx(v, abs=0.06), (k, found)
        far = [c for t, c in found if all(abs(t - at) > 45 for at in want)]
        assert sum(map(abs, far)) < 0.09, (k, far)
        assert len(found) <= 14 and got[k].sigma == pytest.approx(0.5, abs=0.05)


def test_fit_is_the_minimum(named):
    """No step away from the solution lowers the penalised sum; eliminated terms solve their equations."""
    d, y = named["two"]
    design = TR.Design.of(10, 0.8, {"weekly": (7 * 86400.0, 2)})
    x = np.column_stack([design.array(d * 86400, 0.0, d[-1] * 86400), y / np.abs(y).max()])
    beta, s2 = TR.slope_changes(x.T @ x, len(y), design)

    def cost(b):
        other = np.delete(b, range(2, 12))
        return ((x[:, -1] - x[:, :-1] @ b) ** 2).sum() / (2 * s2) + np.abs(b[2:12]).sum() / 0.05 + (other ** 2).sum() / 200

    r = np.random.default_rng(1)
    base = cost(beta)
    for size in (1e-2, 1e-3, 1e-4):
        for _ in range(200):
            assert cost(beta + size * r.normal(size=len(beta)) * (r.random(len(beta)) < .3)) >= base - 1e-6


def test_buckets_change_nothing_and_terms_agree(frame, named):
    a, design = TR.fit_trend(frame.where("series_id = 'two'"))
    b, _ = TR.fit_trend(frame.where("series_id = 'two'"), bucket_seconds=40 * 86400)
    one, two = a.first(), b.first()
    assert np.allclose(one.coef, two.coef, atol=1e-3)
    out = TR.forecast_trend(a, design, frame.where("series_id = 'two'")).orderBy("ts").collect()
    x = design.array(np.array([(r.ts - dt.datetime(1970, 1, 1)).total_seconds() for r in out]), one.start, one.span)
    assert np.allclose([r.forecast for r in out], x @ np.array(one.coef), atol=1e-7)
    assert np.allclose([r.trend + r.yearly + r.weekly + r.daily for r in out], [r.forecast for r in out])
    y = named["two"][1]
    inside = np.mean([r.lower <= v <= r.upper for r, v in zip(out, y)])
    assert 0.76 < inside < 0.84


def test_forecast_beyond_the_history(spark, frame, named):
    fit, design = TR.fit_trend(frame.where("series_id = 'none'"))
    last = START + dt.timedelta(days=float(named["none"][0][-1]))
    future = spark.createDataFrame([("none", last + dt.timedelta(days=k)) for k in (1, 60, 200)], "series_id string, ts timestamp_ntz")
    rows = TR.forecast_trend(fit, design, future).orderBy("ts").collect()
    for r in rows:
        d = (r.ts - START).total_seconds() / 86400
        truth = 30 + 0.05 * d + 4 * np.sin(2 * np.pi * d / 365.25) + 2 * np.cos(2 * np.pi * d / 7) + 1.5 * np.sin(2 * np.pi * d)
        assert abs(r.forecast - truth) < 1.5 + 0.02 * (d - 1000)
    width = [r.upper - r.lower for r in rows]
    assert width[0] <= width[1] <= width[2]


def test_odd_series(spark):
    rows = [("one", START, 1.0), ("null", START, None), ("two", START, 1.0), ("two", START + dt.timedelta(days=1), 2.0)]
    rows += [("zero", START + dt.timedelta(days=t), 0.0) for t in range(30)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")
    fit, design = TR.fit_trend(df)
    got = fit.collect()
    assert [r.series_id for r in got] == ["zero"] and got[0].changes == [] and np.allclose(got[0].coef, 0)
    assert TR.fit_trend(df.limit(0))[0].collect() == []
