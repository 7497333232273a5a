"""Batch inference (I1–I11): bounded-window features, multi-horizon scoring of
many origins in one pass, empirical error bands and intervals."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import all_not_null
from ..functions.timecols import add_steps, step_seconds
from ..session import materialize
from . import features as FE
from .grid import to_grid

LOOKBACK = 192  # steps of history read for one feature row (168 + 24)


def read_window(df: DataFrame, as_of, lookback: int = LOOKBACK, keys=("series_id",), ts="ts",
                step="hour") -> DataFrame:
    """Rows in ``[as_of - lookback, as_of]`` (inclusive) per series, re-gridded.

    ``as_of`` is either a small table ``(keys, as_of)`` (per-series issue
    times) or one literal timestamp; a literal range is a plain filter that
    reaches the Parquet scan (PushedFilters / partition pruning)."""
    keys = list(keys)
    if not isinstance(as_of, DataFrame):
        import datetime as _dt
        hi = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
        lo_t = hi - _dt.timedelta(seconds=lookback * step_seconds(step))
        w = df.where((F.col(ts) >= F.lit(lo_t.isoformat(sep=" ")).cast("timestamp_ntz"))
                     & (F.col(ts) <= F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")))
        b = w.select(*keys).distinct().select(*keys, F.lit(lo_t.isoformat(sep=" ")).cast("timestamp_ntz").alias("_lo"),
                                              F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz").alias("_hi"))
        return to_grid(w, keys, ts, step, bounds=b)
    j = df.join(as_of.select(*keys, "as_of"), keys)
    w = j.where((F.col(ts) >= add_steps("as_of", -lookback, step)) & (F.col(ts) <= F.col("as_of"))).drop("as_of")
    lo = as_of.select(*keys, add_steps("as_of", -lookback, step).alias("_lo"), F.col("as_of").alias("_hi"))
    return to_grid(w, keys, ts, step, bounds=lo)


def on_grid(near: DataFrame, as_of: DataFrame, lookback: int = LOOKBACK, keys=("series_id",), ts="ts", step="hour") -> DataFrame:
    """Rows of ``sources.store.read_recent`` with null rows for the missing steps of
    [as_of - lookback, as_of]: a grid of the window, not of the history."""
    bounds = as_of.select(*keys, add_steps("as_of", -lookback, step).alias("_lo"), F.col("as_of").alias("_hi"))
    return to_grid(near, keys, ts, step, bounds=bounds)


def features_at(recent: DataFrame, as_of: DataFrame, feature_cols: Sequence[str], days: DataFrame | None = None,
                keys=("series_id",), ts="ts", step="hour", strict: bool = False):
    """The feature row at ``as_of`` from a bounded window; equals the
    full-history row when the window covers the longest look-back.

    Returns (rows, rejects); rejects carry a reason ('missing_as_of' or
    'null_feature'). ``strict=True`` raises at execution instead."""
    keys = list(keys)
    f = FE.build_features(recent, "y", days, keys, ts, step)
    at = f.join(as_of.select(*keys, F.col("as_of").alias(ts)), [*keys, ts], "inner")
    ok = all_not_null(feature_cols)
    rows = at.where(ok)
    missing = as_of.select(*keys, F.col("as_of").alias(ts)).join(at.select(*keys, ts), [*keys, ts], "left_anti") \
                   .withColumn("reason", F.lit("missing_as_of"))
    nulls = at.where(~ok).select(*keys, ts).withColumn("reason", F.lit("null_feature"))
    rejects = missing.unionByName(nulls)
    if strict:
        # in a filter: a column that is dropped again would never be evaluated
        rows = at.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("feature row has missing values")).cast("boolean")))
    return rows, rejects


def expand_horizons(rows: DataFrame, horizons: Sequence[int], ts="ts", step="hour") -> DataFrame:
    """I3 input: one row per (feature row, horizon) with the target-time
    calendar columns of F8 (no label needed)."""
    hs = F.array(*[F.lit(int(h)) for h in horizons])
    x = rows.withColumn("horizon", F.explode(hs)).withColumn("_tts", add_steps(ts, F.col("horizon"), step))
    t = F.col("_tts")
    dow = F.weekday(t)
    tgt = FE.cyclical_cols(F.hour(t), dow, F.month(t), prefix="target_") + \
        [(dow >= 5).cast("int").alias("target_is_weekend")]
    return x.select(*rows.columns, "horizon", *tgt)


def score_origins(models: dict, features: DataFrame, origins: DataFrame, horizons: Sequence[int],
                  feature_cols: Sequence[str], keys=("series_id",), ts="ts", step="hour",
                  method: str = "gbt_direct"):
    """Score every requested origin in one pass. Returns (forecasts, rejects); each
    reject (keys, origin, reason) has no row at its origin ('missing_origin') or one
    with a missing feature ('null_feature')."""
    from .models import predict_direct
    keys = list(keys)
    o = origins.select(*keys, F.col("origin").alias(ts))
    origin_cols = [c for c in feature_cols if not c.startswith("target_")]
    at = materialize(features.join(o, [*keys, ts], "inner"))  # read once for each model, and for the rejects
    rows = at.where(all_not_null(origin_cols))
    here = at.groupBy(*keys, ts).agg(F.max(all_not_null(origin_cols).cast("int")).alias("_fine"))
    rejects = o.distinct().join(here, [*keys, ts], "left").where(F.coalesce(F.col("_fine"), F.lit(0)) == 0).select(
        *keys, F.col(ts).alias("origin"), F.when(F.col("_fine").isNull(), "missing_origin").otherwise("null_feature").alias("reason"))
    fc = predict_direct(models, expand_horizons(rows, horizons, ts, step), keys, ts, method, step)
    return fc, rejects


def target_ts(fc: DataFrame, step="hour") -> DataFrame:
    """Target timestamp ``origin + step`` of every forecast row."""
    return fc.withColumn("target_ts", add_steps("origin", F.col("horizon_step"), step))


def error_bands(bt: DataFrame, lower_q: float = 0.1, upper_q: float = 0.9, by: Sequence[str] = ("series_id", "method")) -> DataFrame:
    """I8: empirical quantiles of (actual - forecast) per series, method and horizon step (linear)."""
    from ..functions.quantiles import exact_quantiles
    d = bt.where(F.col("actual").isNotNull() & F.col("forecast").isNotNull()) \
          .withColumn("_err", F.col("actual") - F.col("forecast"))
    return exact_quantiles(d, [*by, "horizon_step"], "_err", [lower_q, upper_q], names=["lower_err", "upper_err"])


def with_interval(fc: DataFrame, bands: DataFrame, by: Sequence[str] = ("series_id", "method")) -> DataFrame:
    """Forecast + band (left join; bands are one row per series, method and step)."""
    j = fc.join(bands, [*by, "horizon_step"], "left")
    return j.withColumn("lower", F.col("forecast") + F.col("lower_err")) \
            .withColumn("upper", F.col("forecast") + F.col("upper_err"))


def score_known(fc: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """MAE of forecasts where the actual is already known."""
    d = fc.where(F.col("actual").isNotNull() & F.col("forecast").isNotNull())
    return d.groupBy(*keys, "method", "origin").agg(F.avg(F.abs(F.col("actual") - F.col("forecast"))).alias("mae"),
                                                  F.count(F.lit(1)).alias("n_known"))
