"""Exploratory profiles (R3–R9) and the holiday calendar."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles
from ..functions.timecols import day_of
from .halo import windowed


def hourly_profile(df: DataFrame, col: str = "y", ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """Mean by (hour) for weekdays and weekends side by side."""
    wk = F.weekday(ts) >= 5
    return df.groupBy(*keys, F.hour(ts).alias("hour")).agg(
        F.avg(F.when(~wk, F.col(col))).alias("weekday_mean"), F.avg(F.when(wk, F.col(col))).alias("weekend_mean"))


def month_year(df: DataFrame, col: str = "y", ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """R4 in long form (month, year, mean); ``metrics.pivot_metric`` gives the matrix."""
    return df.groupBy(*keys, F.month(ts).alias("month"), F.year(ts).alias("year")).agg(F.avg(col).alias("mean"))


def box_stats(df: DataFrame, by: Column | str, col: str = "y", keys: Sequence[str] = (), by_name: str = "group") -> DataFrame:
    """Five-number summary with 1.5·IQR whiskers and outlier count per group."""
    keys = list(keys)
    x = df.select(*keys, (F.col(by) if isinstance(by, str) else by).alias(by_name), F.col(col).alias("_v")) \
          .where(F.col("_v").isNotNull())
    q = exact_quantiles(x, [*keys, by_name], "_v", [0.25, 0.5, 0.75], names=["q1", "median", "q3"]) \
        .join(x.groupBy(*keys, by_name).agg(F.count(F.lit(1)).alias("n")), [*keys, by_name])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = x.join(q, [*keys, by_name])
    lo, hi = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    inside = (F.col("_v") >= lo) & (F.col("_v") <= hi)
    return j.groupBy(*keys, by_name, "q1", "median", "q3", "iqr", "n").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"), F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))


# French public holidays. (month, day) of the fixed-date ones, then
# day offsets from Easter Sunday of the movable ones.
FIXED_HOLIDAYS = [(1, 1, "New Year"), (5, 1, "Labour Day"), (5, 8, "Victory Day"), (7, 14, "Bastille Day"),
                  (8, 15, "Assumption"), (11, 1, "All Saints"), (11, 11, "Armistice"), (12, 25, "Christmas")]
EASTER_OFFSETS = [(1, "Easter Monday"), (39, "Ascension"), (50, "Whit Monday")]


def easter_sunday(year):
    """Gregorian Easter (anonymous algorithm) as a Spark date expression."""
    y = year
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100)
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4)
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4)
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = F.pmod(h + l_ - 7 * m + 114, F.lit(31)) + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def holiday_calendar(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Holiday dimension ``(day TIMESTAMP_NTZ, holiday)`` for the given years."""
    y = F.col(year_col).cast("int")
    rows = [F.struct(F.make_date(y, F.lit(m), F.lit(d)).alias("d"), F.lit(n).alias("holiday"))
            for m, d, n in FIXED_HOLIDAYS]
    rows += [F.struct(F.date_add(easter_sunday(y), off).alias("d"), F.lit(n).alias("holiday"))
             for off, n in EASTER_OFFSETS]
    return years.select(F.inline(F.array(*rows))).select(F.col("d").cast("timestamp_ntz").alias("day"), "holiday")


def years_of(df: DataFrame, ts: str = "ts") -> DataFrame:
    b = df.agg(F.year(F.min(ts)).alias("lo"), F.year(F.max(ts)).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias("year"))


def holiday_effect(df: DataFrame, calendar: DataFrame, col: str = "y", ts: str = "ts",
                   keys: Sequence[str] = ()) -> DataFrame:
    """Mean, exact median and count for holidays vs regular days."""
    cal = calendar.select(F.col("day").alias("_day")).distinct().withColumn("_hol", F.lit(True))
    x = df.withColumn("_day", day_of(ts)).join(F.broadcast(cal), "_day", "left") \
          .withColumn("is_holiday", F.coalesce("_hol", F.lit(False)))
    g = [*keys, "is_holiday"]
    m = x.groupBy(*g).agg(F.avg(col).alias("mean"), F.count(col).alias("n"))
    return m.join(exact_quantiles(x, g, col, [0.5], names=["median"]), g, "left")


def corr_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation for every pair i < j, pairwise null deletion, long form."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.groupBy(*keys).agg(*[F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"_c{i}").alias("corr"))
                     for i, (a, b) in enumerate(pairs)])
    return one.select(*keys, F.inline(rows))


def trailing_mean(df: DataFrame, col: str = "y", n: int = 30, min_periods: int = 1, keys=("series_id",), ts="ts",
                  step="day", bucket_steps=None, bucketed=True) -> DataFrame:
    """Trailing mean over n rows including the current, nulls ignored,
    at least ``min_periods`` values."""
    def mk(w):
        fr = w.rowsBetween(-(n - 1), 0)
        return [F.when(F.count(col).over(fr) >= min_periods, F.avg(col).over(fr)).alias(f"{col}_mean_{n}")]
    return windowed(df, keys, ts, step, n - 1, 0, mk, bucket_steps, bucketed)


def rolling_quantiles(df: DataFrame, col: str = "y", n: int = 30, min_periods: int = 10,
                      qs: Sequence[float] = (0.25, 0.75), keys=("series_id",), ts="ts", step="day",
                      bucket_steps=None, bucketed=True) -> DataFrame:
    """Linear-interpolated rolling quantiles over n rows including the current."""
    def mk(w):
        fr = w.rowsBetween(-(n - 1), 0)
        ok = F.count(col).over(fr) >= min_periods
        return [F.when(ok, F.percentile(col, q).over(fr)).alias(f"{col}_q{int(round(q * 100))}") for q in qs]
    return windowed(df, keys, ts, step, n - 1, 0, mk, bucket_steps, bucketed)
