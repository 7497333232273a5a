"""Raw-to-features refresh as one idempotent batch job.

validate (V1) → minute grid → limited interpolation (G3) → hourly and daily
resampling (R1) → feature table (F7), each written as a Parquet table
partitioned by day under ``out_root``. Every stage reads the table written by
the previous one, so lineage is cut at each write and a re-run replaces the
tables instead of appending. ``refresh_changed`` finds the days whose raw rows
changed and rewrites only the partitions that they reach.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null
from ..functions.timecols import day_of, floor_ts
from ..operators import features as FE
from ..operators import grid as G
from ..operators import quality as V
from ..session import materialize
from ..sources import store as S
from ..sources import tables as T

# Rules checked on the raw events before anything is written.
RAW_RULES = [V.Rule("ts_not_null", "ts", "not_null"), V.Rule("value_non_negative", "value", "ge", lo=0.0)]


def _write_by_day(df: DataFrame, path: str) -> DataFrame:
    S.write_table(df.withColumn("day", day_of("ts").cast("date")), path, ["day"])
    return df.sparkSession.read.parquet(path).drop("day")


TABLES = ("minute", "hourly", "daily", "hourly_features")
LOOKBACK_DAYS = 8  # of the feature table: 168 steps and a shift, in whole days


def _flagged(hourly: DataFrame) -> DataFrame:
    return hourly.where(F.col("y").isNull()).select("series_id", day_of("ts").alias("day")).distinct()


def rebuild(raw: DataFrame, root: str, limit: int = 180) -> None:
    """Write all tables whole from the raw events."""
    grid = G.to_grid(T.minutes_of(raw), ["series_id"], "ts", "minute")
    minute = _write_by_day(G.interpolate_time(grid, ["y"], step="minute", limit=limit), f"{root}/minute")
    hourly = _write_by_day(G.resample(minute, step="hour", mean_cols=["y"], sum_cols=["n_events"]), f"{root}/hourly")
    _write_by_day(G.resample(minute, step="day", mean_cols=["y"], sum_cols=["n_events"]), f"{root}/daily")
    _write_by_day(FE.build_features(hourly, "y", _flagged(hourly)), f"{root}/hourly_features")


def run_refresh(spark: SparkSession, sf_dir: str, out_root: str, limit: int = 180) -> DataFrame:
    """Write minute/hourly/daily/feature tables; return (table, rows, violations)."""
    root = out_root.rstrip("/")
    raw = T.read_table(spark, sf_dir, "events")
    checks = V.validate(raw, RAW_RULES)
    rebuild(raw, root, limit)
    counts = [(name, spark.read.parquet(f"{root}/{name}").count()) for name in TABLES]
    n_bad = int(checks.agg(F.sum("n_failed")).first()[0] or 0)
    return spark.createDataFrame([(n, c, n_bad) for n, c in counts], "table string, n_rows long, raw_violations long")


# ---------------------------------------------------------------- changed days only
def day_marks(raw: DataFrame) -> DataFrame:
    """(series_id, day, n, valid, mark, lo, hi): what a day's raw rows of a series are, as
    counts, an order-free sum of row hashes and the first and last minute."""
    minute = floor_ts("ts", "minute")
    row = F.xxhash64("ts", "value").cast("decimal(38,0)")
    return raw.groupBy(F.col("event_type").alias("series_id"), day_of("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count(nan_to_null("value")).alias("valid"), F.sum(row).alias("mark"), F.min(minute).alias("lo"), F.max(minute).alias("hi"))


def affected_days(old: DataFrame, new: DataFrame, limit: int) -> list:
    """Days of the minute table that may differ: each changed day, the days its fill runs
    on to, the valid day before it (whose last gap may be filled otherwise) with the same,
    and all days between an old and a new first or last day of a series."""
    spill = -(-limit // 1440)
    keys = ["series_id", "day"]
    a, b = (x.select(*keys, F.struct("n", "valid", "mark", "lo", "hi").alias(n)) for x, n in ((old, "a"), (new, "b")))
    both = a.join(b, keys, "full")
    has = (F.coalesce(F.col("a.valid"), F.lit(0)) > 0) | (F.coalesce(F.col("b.valid"), F.lit(0)) > 0)
    before = F.last(F.when(has, F.col("day")), True).over(Window.partitionBy("series_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1))  # days of a series
    changed = both.withColumn("before", before).where(~F.col("a").eqNullSafe(F.col("b")))
    near = changed.select(F.explode(F.array("day", "before")).alias("day")).where("day is not null")
    near = near.select(F.explode(F.sequence("day", F.date_add("day", spill))).alias("day"))
    ends = [x.groupBy("series_id").agg(F.min("day").alias(f"lo{i}"), F.max("day").alias(f"hi{i}")) for i, x in enumerate((old, new))]
    moved = ends[0].join(ends[1], "series_id").select(F.explode(F.array(F.array("lo0", "lo1"), F.array("hi0", "hi1"))).alias("e")).where("e[0] <> e[1]")
    between = moved.select(F.explode(F.sequence(F.array_min("e"), F.array_max("e"))).alias("day"))
    return [r.day for r in near.unionByName(between).distinct().orderBy("day").collect()]  # days of the calendar


def _blocks(days: list) -> list[tuple]:
    """(first, last) of the runs of consecutive days."""
    out: list[tuple] = []
    for d in days:
        if out and (d - out[-1][1]).days == 1:
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def _replace_days(df: DataFrame, path: str, days: list) -> None:
    """Overwrite the partitions of ``days`` alone; a day without rows loses its partition."""
    spark = df.sparkSession
    part = materialize(df.withColumn("day", day_of("ts").cast("date")).where(F.col("day").isin(days)))
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    there = {r.day for r in part.select("day").distinct().collect()}
    S.delete_paths(spark, [f"{path}/day={d.isoformat()}" for d in days if d not in there])


def refresh_changed(raw: DataFrame, out_root: str, limit: int = 180) -> list:
    """Bring the tables under ``out_root`` up to date with the raw events (event_type, ts,
    value) and return the days of the minute table rewritten. Days whose raw rows are as
    at the last refresh, and which no changed day reaches, are neither read nor written.
    The first call builds everything. A run that fails is made good by the next one: the
    marks of the raw days are stored last."""
    spark, root = raw.sparkSession, out_root.rstrip("/")
    marks = materialize(day_marks(raw))
    runs = S.list_names(spark, f"{root}/marks")
    done = [r for r in sorted(runs) if S.exists(spark, f"{root}/marks/{r}/_SUCCESS")]
    if not done:
        rebuild(raw, root, limit)
        days = [r.day for r in spark.read.parquet(f"{root}/minute").select("day").distinct().orderBy("day").collect()]
    else:
        days = affected_days(spark.read.parquet(f"{root}/marks/{done[-1]}"), marks, limit)
        if days:
            _refresh_days(raw, marks, root, days, limit)
    marks.write.mode("overwrite").parquet(f"{root}/marks/{len(runs):08d}")
    return days


def _refresh_days(raw: DataFrame, marks: DataFrame, root: str, days: list, limit: int) -> None:
    spark = raw.sparkSession
    blocks = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(_blocks(days))], "block int, first date, last date")
    # per block and series: from the valid day before to the valid day after it, within the series
    bounds = marks.groupBy("series_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    span = marks.where("valid > 0").join(blocks, how="cross").groupBy("series_id", "block").agg(  # blocks of changed days
        F.max(F.when(F.col("day") < F.col("first"), F.col("day"))).alias("prev"), F.min(F.when(F.col("day") > F.col("last"), F.col("day"))).alias("next"))
    window = bounds.join(blocks, how="cross").join(span, ["series_id", "block"], "left")
    midnight = lambda d: F.col(d).cast("timestamp_ntz")
    window = materialize(window.select(
        "series_id", "block", F.greatest("lo", F.least(midnight("first"), F.coalesce(midnight("prev"), midnight("first")))).alias("_lo"),
        F.least("hi", F.date_add(F.coalesce("next", "last"), 1).cast("timestamp_ntz") - F.expr("interval 1 minute")).alias("_hi")).where("_lo <= _hi"))
    keys = ["series_id", "block"]
    ranges = window.groupBy("block").agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).collect()  # one per block of days
    near = raw.where(" or ".join(f"(ts >= timestamp_ntz'{r.lo}' and ts < timestamp_ntz'{r.hi}' + interval 1 minute)" for r in ranges) or "false")
    rows = T.minutes_of(near.select("event_type", "ts", "value")).join(window, "series_id").where("ts between _lo and _hi").drop("_lo", "_hi")
    filled = G.interpolate_time(G.to_grid(rows, keys, "ts", "minute", bounds=window), ["y"], keys, step="minute", limit=limit)
    inside = filled.join(blocks, "block").where(day_of("ts").cast("date").between(F.col("first"), F.col("last")))
    _replace_days(inside.drop("block", "first", "last"), f"{root}/minute", days)
    minute = spark.read.parquet(f"{root}/minute").where(F.col("day").isin(days)).drop("day")  # only these partitions
    for name, step in (("hourly", "hour"), ("daily", "day")):
        _replace_days(G.resample(minute, step=step, mean_cols=["y"], sum_cols=["n_events"], fill=False), f"{root}/{name}", days)
    later = sorted({d + timedelta(days=k) for d in days for k in range(LOOKBACK_DAYS + 1)})
    read = [(i, a - timedelta(days=LOOKBACK_DAYS + 1 - k), a, b) for i, (a, b) in enumerate(_blocks(later)) for k in range((b - a).days + LOOKBACK_DAYS + 2)]
    read = spark.createDataFrame(read, "block int, day date, first date, last date")
    reads = sorted({d - timedelta(days=k) for d in later for k in range(LOOKBACK_DAYS + 2)})
    hourly = spark.read.parquet(f"{root}/hourly").where(F.col("day").isin(reads)).join(F.broadcast(read), "day").drop("day")  # at most the days of the calendar
    feats = FE.build_features(hourly.drop("first", "last"), "y", _flagged(hourly), keys)
    feats = feats.join(F.broadcast(read.select("block", "first", "last").distinct()), "block")
    _replace_days(feats.where(day_of("ts").cast("date").between(F.col("first"), F.col("last"))).drop("block", "first", "last"), f"{root}/hourly_features", later)
