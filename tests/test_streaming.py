"""Streaming resample emits exactly the closed hourly bins of the batch result."""
import datetime as dt

from pyspark.sql import functions as F

from horizonkit.session import scratch_path
from horizonkit.streaming import resample as SR


def test_stream_resample_matches_batch(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=7 * i), "click" if i % 3 else "view", float(i % 11)) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double")
    src = scratch_path(spark, "t-stream-src")
    df.write.parquet(src)
    out = SR.run_to_table(spark, src, df.schema, scratch_path(spark, "t-stream-out"),
                          scratch_path(spark, "t-stream-ck"))
    got = {(r["series_id"], r["ts"]): (r["n_events"], r["y_sum"]) for r in out.collect()}
    max_ts = max(r[1] for r in rows)
    exp = {}
    for _, ts, k, v in rows:
        h = ts.replace(minute=0, second=0)
        if h + dt.timedelta(hours=1) <= max_ts - dt.timedelta(hours=2):
            n, s = exp.get((k, h), (0, 0.0))
            exp[(k, h)] = (n + 1, s + v)
    assert got == exp
