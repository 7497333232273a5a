"""Regular grids, gaps, interpolation and resampling.

Canonical layout: ``(keys..., ts, value columns...)`` with ``ts`` TIMESTAMP_NTZ.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_null
from ..functions.timecols import add_steps, epoch_seconds, floor_ts, step_seconds, steps_between
from .halo import carry

# Index generation is split into chunks of this many steps so that a very long
# series is generated by many tasks, not by the one that explodes its bounds.
GRID_CHUNK_STEPS = 100_000


def series_bounds(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))


def grid_index(bounds: DataFrame, keys: Sequence[str], step, ts: str = "ts",
               chunk_steps: int = GRID_CHUNK_STEPS) -> DataFrame:
    """Every step between each series' ``_lo`` and ``_hi`` (inclusive)."""
    keys = list(keys)
    n = steps_between("_lo", "_hi", step)
    chunks = (bounds.select(*keys, "_lo", n.alias("_n"))
              .select(*keys, "_lo", "_n", F.explode(F.sequence(F.lit(0).cast("long"),
                                                               F.floor(F.col("_n") / chunk_steps))).alias("_c")))
    chunks = chunks.repartition(*keys, "_c")
    first = F.col("_c") * chunk_steps
    last = F.least(first + chunk_steps - 1, F.col("_n"))
    k = chunks.select(*keys, "_lo", F.explode(F.sequence(first, last)).alias("_k"))
    return k.select(*keys, add_steps("_lo", F.col("_k"), step).alias(ts))


def to_grid(df: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts", step="hour",
            bounds: DataFrame | None = None) -> DataFrame:
    """Insert missing steps as null rows between each series' own min and max."""
    keys = list(keys)
    b = bounds if bounds is not None else series_bounds(df, keys, ts)
    idx = grid_index(b, keys, step, ts)
    return idx.join(df, on=[*keys, ts], how="left")


def align(df: DataFrame, timestamps: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts") -> DataFrame:
    """Values at the given ``(keys, ts)``; absent timestamps give null rows."""
    return timestamps.join(df, on=[*keys, ts], how="left")


def resample(df: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts", step="hour",
             mean_cols: Sequence[str] = (), sum_cols: Sequence[str] = (), fill: bool = True) -> DataFrame:
    """Mean of ``mean_cols``, sum of ``sum_cols`` per bin.

    Every bin between the first and last is emitted when ``fill``; a bin whose
    values are all missing is null for both the mean and the sum.
    """
    keys = list(keys)
    aggs = [F.avg(c).alias(c) for c in mean_cols] + [F.sum(c).alias(c) for c in sum_cols]
    out = df.groupBy(*keys, floor_ts(ts, step).alias(ts)).agg(*aggs)
    return to_grid(out, keys, ts, step) if fill else out


# ---------------------------------------------------------------- gaps
def find_gaps(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("series_id",), ts: str = "ts",
              step="minute", bucket_steps: int | None = None) -> DataFrame:
    """G1: islands of consecutive rows where any of ``cols`` is missing.

    Returns ``keys, start, end, rows, duration_seconds`` with
    ``duration = end - start + one step``.
    """
    keys = list(keys)
    st = step_seconds(step)
    x = df.select(*keys, ts, F.when(~any_null(cols), F.lit(1)).alias("_ok"))
    kw = {"bucket_steps": bucket_steps} if bucket_steps else {}
    x = carry(x, keys, ts, step, ["_ok"], nxt=False, position=False, **kw)
    miss = x.where(F.col("_ok").isNull()).withColumn("_anchor", F.coalesce(F.col("_prev__ok")["pos"], F.lit(0)))
    g = miss.groupBy(*keys, "_anchor").agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
                                           F.count(F.lit(1)).alias("rows"))
    return g.select(*keys, "start", "end", "rows",
                    (F.timestamp_diff("SECOND", F.col("start"), F.col("end")) + F.lit(st)).alias("duration_seconds"))


def gap_summary(df: DataFrame, gaps: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("series_id",),
                threshold_seconds: int = 3 * 3600) -> DataFrame:
    """Per series totals, missing share, gap count and gaps longer than the threshold (strict)."""
    keys = list(keys)
    tot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_rows"),
                                F.count_if(any_null(cols)).alias("missing_rows"))
    long_ = F.col("duration_seconds") > threshold_seconds
    gs = gaps.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_gaps"),
                                 F.count_if(long_).alias("n_long_gaps"),
                                 F.coalesce(F.sum(F.when(long_, F.col("rows"))), F.lit(0)).alias("rows_in_long_gaps"),
                                 F.max("duration_seconds").alias("longest_gap_seconds"))
    j = tot.join(gs, on=keys, how="left")
    return j.select(*keys, "total_rows", "missing_rows",
                    (F.col("missing_rows") * 100.0 / F.col("total_rows")).alias("missing_pct"),
                    F.coalesce("n_gaps", F.lit(0)).alias("n_gaps"),
                    F.coalesce("n_long_gaps", F.lit(0)).alias("n_long_gaps"),
                    F.coalesce("rows_in_long_gaps", F.lit(0)).alias("rows_in_long_gaps"),
                    (F.coalesce("rows_in_long_gaps", F.lit(0)) * 100.0
                     / F.nullif(F.col("missing_rows"), F.lit(0))).alias("long_gap_share_pct"),
                    F.col("longest_gap_seconds"))


def top_gaps(gaps: DataFrame, n: int = 10, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Longest ``n`` gaps per series (ties broken by start)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.desc("duration_seconds"), F.asc("start"))
    return gaps.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


# ---------------------------------------------------------------- interpolation
def interpolate_time(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("series_id",), ts: str = "ts",
                     step="minute", limit: int = 180, whole_gap_only: bool = False,
                     bucket_steps: int | None = None) -> DataFrame:
    """Time-weighted linear fill of interior gaps, per column.

    Default matches forward-limited filling: the first ``limit`` missing rows
    after a valid value are filled in *any* interior gap (a long gap is filled
    partially). ``whole_gap_only=True`` fills only gaps of at most ``limit``
    rows. Leading and trailing gaps stay missing.
    """
    keys = list(keys)
    kw = {"bucket_steps": bucket_steps} if bucket_steps else {}
    x = carry(df, keys, ts, step, cols, **kw)
    secs = epoch_seconds(ts)
    out = []
    for c in cols:
        p, n = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        ok = p.isNotNull() & n.isNotNull() & ((F.col("_pos") - p["pos"]) <= limit)
        if whole_gap_only:
            ok = ok & ((n["pos"] - p["pos"] - 1) <= limit)
        fill = p["v"] + (n["v"] - p["v"]) * ((secs - p["s"]) / (n["s"] - p["s"]))
        out.append(F.when(F.col(c).isNotNull(), F.col(c)).when(ok, fill).alias(c))
    rest = [F.col(c) for c in df.columns if c not in cols]
    return x.select(*rest, *out).select(*df.columns)


def interpolate_position(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("series_id",), ts: str = "ts",
                         step="day", bucket_steps: int | None = None) -> DataFrame:
    """Linear fill by row position; leading nulls take the first valid
    value and trailing nulls the last."""
    keys = list(keys)
    kw = {"bucket_steps": bucket_steps} if bucket_steps else {}
    x = carry(df, keys, ts, step, cols, **kw)
    out = []
    for c in cols:
        p, n = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        frac = (F.col("_pos") - p["pos"]) / (n["pos"] - p["pos"])
        inner = p["v"] + (n["v"] - p["v"]) * frac
        out.append(F.coalesce(F.col(c), F.when(p.isNotNull() & n.isNotNull(), inner), p["v"], n["v"]).alias(c))
    rest = [F.col(c) for c in df.columns if c not in cols]
    return x.select(*rest, *out).select(*df.columns)
