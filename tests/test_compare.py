"""Folds, Diebold–Mariano, worst cases, context labels, distributions (C*, K*)."""
import datetime as dt

import numpy as np
import pytest

from horizonkit.functions.distributions import chi2_sf, t_two_sided_p
from horizonkit.operators import compare as C

T0 = dt.datetime(2020, 1, 1)
BT = "series_id string, origin timestamp_ntz, horizon_step int, method string, actual double, forecast double"


def results(spark):
    """10 daily origins × 3 steps; method_a off by 0.1, method_b by 1.0; 'partial' has 4 origins."""
    rows = []
    for o in range(10):
        for h in range(1, 4):
            a = float(o + h)
            rows += [("s", T0 + dt.timedelta(days=o), h, "method_a", a, a + 0.1),
                     ("s", T0 + dt.timedelta(days=o), h, "method_b", a, a + 1.0)]
            if o < 4:
                rows.append(("s", T0 + dt.timedelta(days=o), h, "partial", a, a + 0.05))
    return spark.createDataFrame(rows, BT)


def test_folds_match_array_split(spark):
    for n, k in [(10, 3), (12, 4), (288, 4), (289, 4)]:
        o = spark.createDataFrame([(T0 + dt.timedelta(days=i),) for i in range(n)], "origin timestamp_ntz")
        got = [r["fold"] for r in C.assign_folds(o, k).orderBy("origin").collect()]
        exp = [f for f, chunk in enumerate(np.array_split(np.arange(n), k)) for _ in chunk]
        assert got == exp


def test_loss_kind_guard():
    with pytest.raises(ValueError):
        from horizonkit.functions.exprs import point_loss
        point_loss("huber")


def test_dm_common_origins_and_degenerate(spark):
    bt = results(spark)
    dm = {(r["method_a"], r["method_b"]): r for r in
          C.dm_tests(bt, ["method_a", "method_b", "partial"]).collect()}
    assert dm[("method_a", "partial")]["n_origins"] == 4
    assert abs(dm[("method_a", "method_b")]["mean_loss_diff"] + 0.9) < 1e-9
    # constant loss difference → zero variance → undefined statistic
    assert dm[("method_a", "method_b")]["dm_statistic"] is None
    assert dm[("method_a", "method_b")]["significant"] is False


def test_dm_direction(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(200):
        o = T0 + dt.timedelta(days=i)
        rows += [("s", o, 1, "good", 0.0, float(rng.normal(0.1, 0.01))),
                 ("s", o, 1, "bad", 0.0, float(rng.normal(1.0, 0.01))),
                 ("s", o, 1, "same1", 0.0, float(rng.normal(1.0, 0.1))),
                 ("s", o, 1, "same2", 0.0, float(rng.normal(1.0, 0.1)))]
    bt = spark.createDataFrame(rows, BT)
    r = C.dm_tests(bt, ["good", "bad"]).first()
    assert r["dm_statistic"] < 0 and r["p_value"] < 1e-6 and r["significant"]
    r2 = C.dm_tests(bt, ["same1", "same2"]).first()
    assert r2["p_value"] > 0.01


def test_worst_cases_order(spark):
    w = C.worst_cases(results(spark), 5, methods=["method_b"]).orderBy("case_rank").collect()
    assert len(w) == 5 and all(abs(r["loss"] - 1.0) < 1e-9 for r in w)
    assert [r["case_rank"] for r in w] == [1, 2, 3, 4, 5]


def test_label_context_priority(spark):
    cases = spark.createDataFrame([("s", T0, 1, "m"), ("s", T0 + dt.timedelta(days=3), 1, "m"),
                                   ("s", T0 + dt.timedelta(days=5), 1, "m")],
                                  "series_id string, origin timestamp_ntz, horizon_step int, method string")
    ranges = spark.createDataFrame([(T0 - dt.timedelta(days=1), T0 + dt.timedelta(hours=5))],
                                   "range_start timestamp_ntz, range_end timestamp_ntz")
    days = spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=3),)], "day timestamp_ntz")
    out = {r["origin"]: r["context"] for r in C.label_context(cases, ranges, days).collect()}
    assert out[T0] == "near_data_gap"
    assert out[T0 + dt.timedelta(days=3)] == "flagged_anomaly"
    assert out[T0 + dt.timedelta(days=5)] == ""


def test_improvement_and_cost(spark):
    lb = spark.createDataFrame([("naive", 1.0), ("m", 0.8)], "method string, MAE double")
    imp = {r["method"]: r for r in C.improvement(lb, "naive").collect()}
    assert abs(imp["m"]["improvement_pct"] - 20.0) < 1e-9
    cost = C.avoided_cost(C.improvement(lb, "naive"), C.params_table(spark)).where("method = 'm'").first()
    assert abs(cost["avoided_cost"] - 0.2 * 8760 * 10000 / 1000 * 20.0) < 1e-6


def test_t_and_chi2_tails():
    assert abs(t_two_sided_p(2.0, 10) - 0.073388) < 1e-6
    assert abs(t_two_sided_p(2.228139, 10) - 0.05) < 1e-6
    assert abs(chi2_sf(3.841459, 1) - 0.05) < 1e-6
    assert abs(chi2_sf(18.307038, 10) - 0.05) < 1e-6


def test_context_bands_flags_and_gaps_stay_with_their_series(spark):
    """Two series: what one misses, flags or errs by does not touch the other."""
    import datetime as dt

    from horizonkit.operators import anomaly as A
    from horizonkit.operators import features as FE
    from horizonkit.operators import inference as I
    day = dt.datetime(2024, 3, 1)
    cases = spark.createDataFrame([("a", day, "m"), ("b", day, "m")], "series_id string, origin timestamp_ntz, method string")
    gaps = spark.createDataFrame([("a", day, day)], "series_id string, range_start timestamp_ntz, range_end timestamp_ntz")
    flagged = spark.createDataFrame([("b", day)], "series_id string, day timestamp_ntz")
    assert {r.series_id: r.context for r in C.label_context(cases, gaps, flagged).collect()} == {"a": "near_data_gap", "b": "flagged_anomaly"}
    assert {r.series_id: r.context for r in C.label_context(cases, gaps.drop("series_id"), flagged).collect()} == {"a": "near_data_gap", "b": "near_data_gap"}
    rows = spark.createDataFrame([("a", day), ("b", day)], "series_id string, ts timestamp_ntz")
    assert {r.series_id: r.is_flagged_anomaly for r in FE.day_flag(rows, flagged).collect()} == {"a": 0, "b": 1}
    assert {r.series_id: r.is_flagged_anomaly for r in FE.day_flag(rows, flagged.drop("series_id")).collect()} == {"a": 1, "b": 1}
    assert {r.series_id: r.is_known_gap for r in A.split_known(rows, flagged).collect()} == {"a": False, "b": True}
    bt = spark.createDataFrame([(s, "m", 1, 10.0, 10.0 - k * e) for s, e in (("a", 1.0), ("b", 5.0)) for k in range(11)],
                               "series_id string, method string, horizon_step int, actual double, forecast double")
    bands = I.error_bands(bt)
    assert {r.series_id: (r.lower_err, r.upper_err) for r in bands.collect()} == {"a": (1.0, 9.0), "b": (5.0, 45.0)}
    fc = spark.createDataFrame([("a", "m", 1, 100.0), ("b", "m", 1, 100.0), ("c", "m", 1, 100.0)], "series_id string, method string, horizon_step int, forecast double")
    assert {r.series_id: r.upper for r in I.with_interval(fc, bands).collect()} == {"a": 109.0, "b": 145.0, "c": None}
