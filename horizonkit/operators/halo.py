"""Window execution that never puts a whole series into one task.

``Window.partitionBy(series_id)`` sends every row of a series to one task; a
series holding a third of all rows would then run in a single task. Two
patterns split a series into time buckets instead:

* **Halo buckets** (bounded frames: lags, rolling stats, leads). Each row is
  assigned to bucket ``floor(epoch / B)``; rows within ``before`` steps of the
  end of their bucket are also copied into the next bucket (and rows within
  ``after`` steps of the start into the previous one). A window partitioned by
  ``(keys, bucket)`` then sees every row its frame needs, and only the bucket's
  own rows are kept. Extra rows: ``(before + after) / B`` of the input.

* **Two-phase carry** (unbounded frames: last/first non-null value, running
  row position). Each bucket computes its own answer plus a one-row summary;
  a window over the small summary table carries values across buckets and is
  joined back on ``(keys, bucket)``.

Row-positional frames equal time frames only on a dense grid
(``grid.to_grid``); the feature operators are defined on such grids.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_seconds, step_seconds

B_COL, OWN_COL, S_COL, RN_COL = "_hk_b", "_hk_own", "_hk_s", "_hk_rn"
MIN_BUCKET_STEPS = 2048


def default_bucket_steps(before: int = 0, after: int = 0) -> int:
    return max(8 * max(before, after, 1), MIN_BUCKET_STEPS)


def with_halo(df: DataFrame, ts: str, step, before: int = 0, after: int = 0,
              bucket_steps: int | None = None) -> DataFrame:
    """Add bucket id and own-row flag, duplicating halo rows into neighbours."""
    bucket_steps = bucket_steps or default_bucket_steps(before, after)
    if before > bucket_steps or after > bucket_steps:
        raise ValueError("bucket must be at least as long as the look-back/look-ahead")
    st = step_seconds(step)
    width = bucket_steps * st
    s = epoch_seconds(ts)
    b = F.floor(s / F.lit(width))
    tags = [F.struct(b.alias(B_COL), F.lit(True).alias(OWN_COL))]
    if before > 0:
        tags.append(F.when(s >= (b + 1) * width - before * st,
                           F.struct((b + 1).alias(B_COL), F.lit(False).alias(OWN_COL))))
    if after > 0:
        tags.append(F.when(s < b * width + after * st,
                           F.struct((b - 1).alias(B_COL), F.lit(False).alias(OWN_COL))))
    if len(tags) == 1:
        return df.withColumn(B_COL, b).withColumn(OWN_COL, F.lit(True))
    return df.select("*", F.inline(F.filter(F.array(*tags), lambda t: t.isNotNull())))


def windowed(df: DataFrame, keys: Sequence[str], ts: str, step, before: int, after: int,
             make_cols: Callable[[Window], list[Column]], bucket_steps: int | None = None,
             bucketed: bool = True) -> DataFrame:
    """Evaluate bounded window expressions per series.

    ``make_cols(w)`` receives an ordered window spec (``partitionBy`` keys,
    ``orderBy`` ts) and returns aliased columns; frames must stay within
    ``before`` rows back and ``after`` rows ahead.
    """
    keys = list(keys)
    if not bucketed:
        w = Window.partitionBy(*keys).orderBy(ts)
        return df.select("*", *make_cols(w))
    x = with_halo(df, ts, step, before, after, bucket_steps)
    w = Window.partitionBy(*keys, B_COL).orderBy(ts)
    return (x.select("*", *make_cols(w)).where(F.col(OWN_COL)).drop(B_COL, OWN_COL))


def carry(df: DataFrame, keys: Sequence[str], ts: str, step, cols: Sequence[str],
          bucket_steps: int = 4 * MIN_BUCKET_STEPS, prev: bool = True, nxt: bool = True,
          position: bool = True) -> DataFrame:
    """Per series: global 1-based row position ``_pos`` and, for each column c,
    ``_prev_c`` / ``_next_c`` = struct(pos, s, v) of the last non-null value at
    or before the row and the first at or after it (``s`` = epoch seconds).
    """
    keys = list(keys)
    width = bucket_steps * step_seconds(step)
    base = (df.withColumn(S_COL, epoch_seconds(ts))
              .withColumn(B_COL, F.floor(F.col(S_COL) / F.lit(width))))
    w_in = Window.partitionBy(*keys, B_COL).orderBy(ts)

    def vstruct(c):
        return F.when(F.col(c).isNotNull(),
                      F.struct(F.col(RN_COL).alias("pos"), F.col(S_COL).alias("s"), F.col(c).alias("v")))

    # "next" frames run over the reversed order so every frame is a growing
    # prefix (ROWS UNBOUNDED PRECEDING); a shrinking UNBOUNDED FOLLOWING frame
    # is re-aggregated per row by Spark and is quadratic in the bucket size.
    w_rev = Window.partitionBy(*keys, B_COL).orderBy(F.col(ts).desc())
    x = base.withColumn(RN_COL, F.row_number().over(w_in))
    in_cols = []
    for c in cols:
        if prev:
            in_cols.append(F.last(vstruct(c), True).over(
                w_in.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_hk_pin_{c}"))
        if nxt:
            in_cols.append(F.last(vstruct(c), True).over(
                w_rev.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_hk_nin_{c}"))
    x = x.select("*", *in_cols)

    # one row per (series, bucket)
    aggs = [F.count(F.lit(1)).alias("_hk_cnt")]
    for c in cols:
        if prev:
            aggs.append(F.max(vstruct(c)).alias(f"_hk_last_{c}"))
        if nxt:
            aggs.append(F.min(vstruct(c)).alias(f"_hk_first_{c}"))
    summ = x.groupBy(*keys, B_COL).agg(*aggs)
    w_b = Window.partitionBy(*keys).orderBy(B_COL)
    w_b_rev = Window.partitionBy(*keys).orderBy(F.col(B_COL).desc())
    summ = summ.withColumn("_hk_off", F.coalesce(F.sum("_hk_cnt").over(
        w_b.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def globalise(sc: str, off: Column) -> Column:
        v = F.col(sc)
        return F.when(v.isNotNull(), F.struct((v["pos"] + off).alias("pos"), v["s"].alias("s"), v["v"].alias("v")))

    carry_cols = []
    for c in cols:
        if prev:
            carry_cols.append(F.last(globalise(f"_hk_last_{c}", F.col("_hk_off")), True).over(
                w_b.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_hk_cp_{c}"))
        if nxt:
            carry_cols.append(F.last(globalise(f"_hk_first_{c}", F.col("_hk_off")), True).over(
                w_b_rev.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_hk_cn_{c}"))
    summ = summ.select(*keys, B_COL, "_hk_off", *carry_cols)

    y = x.join(summ, on=[*keys, B_COL], how="inner")
    out = [F.col(c) for c in df.columns]
    if position:
        out.append((F.col("_hk_off") + F.col(RN_COL)).alias("_pos"))
    for c in cols:
        if prev:
            out.append(F.coalesce(globalise(f"_hk_pin_{c}", F.col("_hk_off")), F.col(f"_hk_cp_{c}")).alias(f"_prev_{c}"))
        if nxt:
            out.append(F.coalesce(globalise(f"_hk_nin_{c}", F.col("_hk_off")), F.col(f"_hk_cn_{c}")).alias(f"_next_{c}"))
    return y.select(*out)
