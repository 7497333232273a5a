"""Comparison, significance and business measures."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.distributions import t_pvalue_udf
from ..functions.exprs import point_loss
from ..functions.timecols import day_of, season


def add_season(df: DataFrame, date_col: str = "origin") -> DataFrame:
    """C1."""
    return df.withColumn("season", season(date_col))


def assign_folds(bt_or_origins: DataFrame, n_folds: int = 4, step="day") -> DataFrame:
    """Contiguous chronological folds over the distinct sorted origins;
    the first ``n mod k`` folds get one extra origin (as an array split).

    The global rank of each origin comes from the two-phase carry (per time
    bucket, then carried bucket offsets), so no unpartitioned window is used;
    rank r maps to fold ``r // (q+1)`` for the first ``m·(q+1)`` ranks and
    ``m + (r - m·(q+1)) // q`` after them (``q, m = divmod(n, k)``)."""
    from .halo import carry
    o = bt_or_origins.select("origin").distinct().withColumn("_all", F.lit(1))
    ranked = carry(o, ["_all"], "origin", step, [], prev=False, nxt=False, position=True)
    n = o.groupBy("_all").agg(F.count(F.lit(1)).alias("_n"))
    x = ranked.join(n, "_all")
    r = F.col("_pos") - 1
    q = F.floor(F.col("_n") / n_folds)
    m = F.col("_n") - q * n_folds
    head = m * (q + 1)
    fold = F.when(r < head, F.floor(r / (q + 1))).otherwise(m + F.floor((r - head) / F.greatest(q, F.lit(1))))
    return x.select("origin", fold.cast("int").alias("fold"))


def fold_labels(folds: DataFrame) -> DataFrame:
    """C3: "Mon dd - Mon dd" per fold."""
    g = folds.groupBy("fold").agg(F.min("origin").alias("fold_start"), F.max("origin").alias("fold_end"))
    return g.withColumn("label", F.concat_ws(" - ", F.date_format("fold_start", "MMM dd"),
                                             F.date_format("fold_end", "MMM dd")))


def origin_loss(bt: DataFrame, kind: str = "absolute", keys: Sequence[str] = ("series_id",),
                methods: Sequence[str] | None = None) -> DataFrame:
    """C4+C5: mean pointwise loss per (keys, method, origin) after dropping null pairs."""
    keys = list(keys)
    d = bt.where(F.col("actual").isNotNull() & F.col("forecast").isNotNull())
    if methods is not None:
        d = d.where(F.col("method").isin(list(methods)))
    return d.groupBy(*keys, "method", "origin").agg(F.avg(point_loss(kind)).alias("loss"))


def dm_statistics(bt: DataFrame, methods: Sequence[str], kind: str = "absolute", h: int = 1,
                  keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """C6+C7 (statistic): Diebold–Mariano on common origins for every pair
    i < j in the given method order, with the small-sample correction.

    ``d = loss_a - loss_b`` per common origin; long-run variance =
    population variance + 2·Σ_{k<h} mean((d_t - d̄)(d_{t-k} - d̄)) over the
    n-k available products. Zero or negative variance gives NULL.
    """
    keys = list(keys)
    spark = bt.sparkSession
    order = spark.createDataFrame([(m, i) for i, m in enumerate(methods)], "method string, method_rank int")
    lo = origin_loss(bt, kind, keys, methods).join(F.broadcast(order), "method")
    a = lo.select(*keys, "origin", F.col("method").alias("method_a"), F.col("method_rank").alias("ra"),
                  F.col("loss").alias("loss_a"))
    b = lo.select(*keys, "origin", F.col("method").alias("method_b"), F.col("method_rank").alias("rb"),
                  F.col("loss").alias("loss_b"))
    pairs = a.join(b, [*keys, "origin"]).where(F.col("ra") < F.col("rb"))
    pk = [*keys, "method_a", "method_b"]
    d = pairs.select(*pk, "origin", (F.col("loss_a") - F.col("loss_b")).alias("d"))
    w = Window.partitionBy(*pk)
    d = d.withColumn("_dbar", F.avg("d").over(w)).withColumn("_c", F.col("d") - F.col("_dbar"))
    aggs = [F.count(F.lit(1)).alias("n_origins"), F.avg("d").alias("mean_loss_diff"),
            F.avg(F.col("_c") * F.col("_c")).alias("_g0")]
    if h > 1:
        wo = Window.partitionBy(*pk).orderBy("origin")
        for k in range(1, h):
            d = d.withColumn(f"_p{k}", F.col("_c") * F.lag("_c", k).over(wo))
            aggs.append(F.avg(f"_p{k}").alias(f"_g{k}"))
    s = d.groupBy(*pk).agg(*aggs)
    lrv = F.col("_g0")
    for k in range(1, h):
        lrv = lrv + 2 * F.coalesce(F.col(f"_g{k}"), F.lit(0.0))
    n = F.col("n_origins").cast("double")
    corr = F.sqrt((n + 1 - 2 * h + h * (h - 1) / n) / n)
    dm = F.when(lrv > 1e-18, F.col("mean_loss_diff") / F.sqrt(lrv / n) * corr)
    return s.select(*pk, "mean_loss_diff", dm.alias("dm_statistic"), F.col("n_origins"))


def dm_tests(bt: DataFrame, methods: Sequence[str], kind: str = "absolute", h: int = 1,
             keys: Sequence[str] = ("series_id",), alpha: float = 0.05) -> DataFrame:
    """Statistic, two-sided Student-t(n-1) p-value, significance flag."""
    s = dm_statistics(bt, methods, kind, h, keys)
    p = t_pvalue_udf(F.col("dm_statistic"), (F.col("n_origins") - 1).cast("double"))
    s = s.withColumn("p_value", F.when(F.col("dm_statistic").isNotNull(), p))
    return s.withColumn("significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def worst_cases(bt: DataFrame, n: int = 10, kind: str = "absolute", keys: Sequence[str] = ("series_id",),
                methods: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` largest pointwise losses per (keys, method); ties broken by origin, step."""
    keys = list(keys)
    d = bt.where(F.col("actual").isNotNull() & F.col("forecast").isNotNull())
    if methods is not None:
        d = d.where(F.col("method").isin(list(methods)))
    d = d.withColumn("loss", point_loss(kind))
    w = Window.partitionBy(*keys, "method").orderBy(F.desc("loss"), "origin", "horizon_step")
    return d.withColumn("case_rank", F.row_number().over(w)).where(F.col("case_rank") <= n)


def label_context(cases: DataFrame, gap_ranges: DataFrame, flagged_days: DataFrame,
                  date_col: str = "origin", keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """``near_data_gap`` if the day lies in any closed range, else
    ``flagged_anomaly`` if the day is flagged, else ''. A lookup table with the key
    columns labels its own series only, one without them all.

    The range test is turned into an equi-join: each ``(range_start,
    range_end)`` is expanded to its days and de-duplicated, so both lookup
    tables hold at most one row per series and calendar day (AQE broadcasts
    them when small)."""
    of_gap, of_day = ([k for k in keys if k in t.columns] for t in (gap_ranges, flagged_days))
    span = F.sequence(day_of("range_start").cast("date"), day_of("range_end").cast("date"))
    gd = (gap_ranges.select(*of_gap, F.explode(span).alias("_d")).select(*of_gap, F.col("_d").cast("timestamp_ntz").alias("_day"))
                    .distinct().withColumn("_gap", F.lit(True)))
    fd = flagged_days.select(*of_day, day_of("day").alias("_day")).distinct().withColumn("_flag", F.lit(True))
    j = cases.withColumn("_day", day_of(date_col)).join(gd, [*of_gap, "_day"], "left").join(fd, [*of_day, "_day"], "left")
    ctx = F.when(F.col("_gap"), "near_data_gap").when(F.col("_flag"), "flagged_anomaly").otherwise("")
    return j.withColumn("context", ctx).select(*cases.columns, "context")


def flagged_share(labelled: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Share of worst cases with a context label, per method."""
    return labelled.groupBy(*keys, "method").agg(
        F.avg((F.col("context") != "").cast("double")).alias("flagged_share"),
        F.count(F.lit(1)).alias("n_cases"))


def improvement(lb: DataFrame, baseline: str, keys: Sequence[str] = ()) -> DataFrame:
    """K1: % MAE improvement of each method over the baseline method."""
    keys = list(keys)
    base = lb.where(F.col("method") == baseline).select(*keys, F.col("MAE").alias("baseline_mae"))
    if keys:
        j = lb.join(base, keys)
    else:  # one baseline row: join on a constant key
        j = lb.withColumn("_one", F.lit(1)).join(base.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return j.select(*keys, "method", "MAE", "baseline_mae",
                    ((F.col("baseline_mae") - F.col("MAE")) / F.nullif(F.col("baseline_mae"), F.lit(0.0)) * 100)
                    .alias("improvement_pct"))


def avoided_cost(imp: DataFrame, params: DataFrame) -> DataFrame:
    """K2: ΔMAE (kW) · 8760 h · households / 1000 · premium per MWh, for each
    row of a parameter table ``(households, premium_per_mwh)`` (what-if grid)."""
    delta = F.col("baseline_mae") - F.col("MAE")
    j = imp.withColumn("_one", F.lit(1)).join(F.broadcast(params.withColumn("_one", F.lit(1))), "_one").drop("_one")
    return j.withColumn("avoided_cost", delta * 8760 * F.col("households") / 1000 * F.col("premium_per_mwh"))


def params_table(spark: SparkSession, households=(10_000,), premiums=(20.0,)) -> DataFrame:
    """Default what-if parameters (10,000 households, $20/MWh)."""
    rows = [(int(h), float(p)) for h in households for p in premiums]
    return spark.createDataFrame(rows, "households long, premium_per_mwh double")
