"""Reading the input tables and binding them to the series layout.

Bindings (kept identical in the DuckDB oracle SQL, see ``plans.oracle``):

* minute series  – ``events`` per ``event_type`` and minute: mean ``value``
  (``y``) and event count (``n_events``); minutes without events are absent.
* hourly grid    – R1 over the minute series: mean of ``y``, sum of
  ``n_events``; dense per series (empty hours are null rows).
* daily grid     – ``orders`` per ``o_orderpriority`` and order date: total
  price (``y``) and order count (``n_orders``); dense per series.
* multivariate daily – ``lineitem`` per ship date (one series ``all``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null
from ..functions.timecols import day_of, floor_ts
from ..operators.grid import interpolate_time, resample, to_grid

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def minutes_of(events: DataFrame) -> DataFrame:
    """Per series and minute the mean value and the number of raw events."""
    return (events.groupBy(F.col("event_type").alias("series_id"), floor_ts("ts", "minute").alias("ts"))
                  .agg(F.avg(nan_to_null("value")).alias("y"), F.count(F.lit(1)).alias("n_events")))


def minute_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minutes_of(read_table(spark, sf_dir, "events").select("event_type", "ts", "value"))


def minute_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense minute grid per series (missing minutes are null rows)."""
    return to_grid(minute_series(spark, sf_dir), ["series_id"], "ts", "minute")


def hourly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(minute_series(spark, sf_dir), ["series_id"], "ts", "hour",
                    mean_cols=["y"], sum_cols=["n_events"])


def refreshed_hourly(spark: SparkSession, sf_dir: str, limit: int = 180) -> DataFrame:
    """S11 refresh: minute grid → limited time interpolation (G3) → hourly.
    The model-facing hourly table, as produced by the raw-to-features job."""
    filled = interpolate_time(minute_grid(spark, sf_dir), ["y"], step="minute", limit=limit)
    return resample(filled, ["series_id"], "ts", "hour", mean_cols=["y"], sum_cols=["n_events"])


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice")
    return (o.groupBy(F.col("o_orderpriority").alias("series_id"), day_of("o_orderdate").alias("ts"))
             .agg(F.sum(nan_to_null("o_totalprice")).alias("y"), F.count(F.lit(1)).alias("n_orders")))


def daily_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_grid(daily_series(spark, sf_dir), ["series_id"], "ts", "day")


LINEITEM_MEASURES = ("quantity", "revenue", "discount", "tax", "n_lines")


def lineitem_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_shipdate", "l_quantity", "l_extendedprice",
                                                      "l_discount", "l_tax")
    d = (li.groupBy(day_of("l_shipdate").alias("ts"))
           .agg(F.sum(nan_to_null("l_quantity")).alias("quantity"),
                F.sum(nan_to_null(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("revenue"),
                F.avg(nan_to_null("l_discount")).alias("discount"), F.avg(nan_to_null("l_tax")).alias("tax"),
                F.count(F.lit(1)).cast("double").alias("n_lines"))
           .withColumn("series_id", F.lit("all")))
    return to_grid(d, ["series_id"], "ts", "day")
