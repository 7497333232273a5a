"""The refresh job writes its tables idempotently and matches the lazy plan."""
import os

import pytest

from horizonkit.plans.refresh import run_refresh
from horizonkit.session import scratch_path
from horizonkit.sources import tables as T

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_refresh_idempotent(spark):
    root = scratch_path(spark, "t-refresh")
    a = {r["table"]: r["n_rows"] for r in run_refresh(spark, SF, root).collect()}
    b = {r["table"]: r["n_rows"] for r in run_refresh(spark, SF, root).collect()}
    assert a == b and set(a) == {"minute", "hourly", "daily", "hourly_features"}
    assert a["hourly"] == T.refreshed_hourly(spark, SF).count() == a["hourly_features"]


def test_rerun_replaces_stale_partitions(spark, tmp_path):
    from horizonkit.sources.store import write_table
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string"), path, ["day"])
    write_table(spark.createDataFrame([(3, "b")], "x int, day string"), path, ["day"])
    assert [(r.x, r.day) for r in spark.read.parquet(path).collect()] == [(3, "b")]


def test_raw_times_are_wall_clock_in_any_zone(spark, tmp_path):
    import datetime as dt

    from horizonkit.sources.store import read_delimited, write_delimited
    rows = [(dt.datetime(2007, 3, 25, h, 30), float(h)) for h in (1, 2, 3)]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Europe/Paris", "America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            path = str(tmp_path / zone.replace("/", "_"))
            df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
            write_delimited(df, path, "ts", ["v"], ["v"])
            got = read_delimited(spark, path, columns=("Date", "Time", "v"), rename={}).orderBy("datetime").collect()
            assert [(r.datetime, r.v) for r in got] == rows
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_registry_raises_on_unreadable_table(spark, tmp_path):
    import pytest

    from horizonkit.sources.store import register_version
    bad = tmp_path / "reg"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        register_version(spark, str(bad), "m", "p")
    assert register_version(spark, str(tmp_path / "new"), "m", "p") == 1


def test_concurrent_writers_get_different_versions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from horizonkit.sources.store import read_versions, register_version, resolve_alias, versions
    reg = str(tmp_path / "reg")
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda k: register_version(spark, reg, f"m{k % 2}", f"/bundle{k}", "champion" if k < 8 else None), range(12)))
    rows = read_versions(spark, reg).collect()
    assert len(rows) == 12 and len({(r.name, r.version) for r in rows}) == 12 and {r.path for r in rows} == {f"/bundle{k}" for k in range(12)}
    for k, v in enumerate(got):
        assert any((r.name, r.version, r.path) == (f"m{k % 2}", v, f"/bundle{k}") for r in rows)
    best = max((r.version, r.path) for r in rows if r.name == "m0" and r.alias == "champion")
    found = resolve_alias(spark, reg, "m0", "champion").first()
    assert (found.version, found.path) == best
    assert sum(r.is_latest for r in versions(spark, reg).collect()) == 2
    with pytest.raises(ValueError):
        register_version(spark, reg, "a/b", "/x")


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_type string, ts timestamp_ntz, value double")


def test_changed_days_equal_a_full_rebuild(spark, tmp_path):
    """Random edits of raw rows: the tables equal those built anew, and other days' files stay."""
    import datetime as dt
    import random

    from horizonkit.plans.refresh import TABLES, rebuild, refresh_changed
    r = random.Random(4)
    start = dt.datetime(2024, 1, 1)

    def day_rows(series, day, share=0.04):
        return [(series, start + dt.timedelta(days=day, minutes=m, seconds=r.randrange(60)), None if r.random() < .1 else round(r.random() * 9, 3))
                for m in range(1440) if r.random() < share]

    rows = [x for s in ("a", "b") for d in range(24) if not (s == "a" and d in (6, 7, 8, 9)) for x in day_rows(s, d)]
    rows += day_rows("late", 20)
    days = refresh_changed(_events(spark, rows), f"{tmp_path}/inc")
    assert len(days) == 24
    on = lambda x, s, d: x[0] == s and (x[1] - start).days == d
    edits = [  # a day loses its rows and a value comes inside a long gap; a series goes on after five days; one begins later; nothing
        lambda: [x for x in rows if not on(x, "b", 12)] + day_rows("a", 8, 0.01),
        lambda: [(s, t, (v or 0.0) + 1 if on((s, t, v), "a", 3) else v) for s, t, v in rows] + day_rows("late", 25),
        lambda: [x for x in rows if not (x[0] == "late" and (x[1] - start).days == 20)],
        lambda: rows,
    ]
    for k, edit in enumerate(edits):
        rows = edit()
        before = {f: f.stat().st_mtime_ns for f in (tmp_path / "inc").rglob("*.parquet")}
        days = refresh_changed(_events(spark, rows), f"{tmp_path}/inc")
        rebuild(_events(spark, rows), f"{tmp_path}/full{k}")
        for name in TABLES:
            a, b = (spark.read.parquet(f"{tmp_path}/{x}/{name}") for x in ("inc", f"full{k}"))
            got, want = ({(x.series_id, x.ts): x.asDict() for x in t.select(sorted(b.columns)).collect()} for t in (a, b))
            assert set(got) == set(want), (k, name, sorted(set(got) ^ set(want))[:4])
            for key, x in want.items():
                for c, v in x.items():
                    assert got[key][c] == (pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else v), (k, name, key, c)
        keep = {f for f in before if "/marks/" not in str(f) and not any((d - start.date()).days <= (dt.date.fromisoformat(f.parent.name[4:]) - start.date()).days
                <= (d - start.date()).days + (8 if "features" in str(f) else 0) for d in days)}
        assert all(f.exists() and f.stat().st_mtime_ns == before[f] for f in keep) and len(keep) > 10
        assert (len(days) == 0) == (k == 3) and len(days) <= 10, (k, days)
