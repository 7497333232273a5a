"""Sources and sinks.

All writes are idempotent: whole tables are replaced, results and forecasts by partition, so
a re-run replaces a partition instead of appending to it. Paths are under the
shared checkpoint folder (``spark.checkpoint.dir``) unless given.
"""

from __future__ import annotations

import json
import random
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import nan_to_null
from ..functions.timecols import add_steps

# Column layout of the raw semicolon-delimited measurement text.
RAW_COLUMNS = ["Date", "Time", "Global_active_power", "Global_reactive_power", "Voltage", "Global_intensity",
               "Sub_metering_1", "Sub_metering_2", "Sub_metering_3"]
RAW_RENAME = {"Global_active_power": "global_active_power", "Global_reactive_power": "global_reactive_power",
              "Voltage": "voltage", "Global_intensity": "global_intensity", "Sub_metering_1": "sub_metering_1",
              "Sub_metering_2": "sub_metering_2", "Sub_metering_3": "sub_metering_3"}
RAW_MISSING = "?"
RAW_TS_FORMAT = "d/M/yyyy H:mm:ss"
SAVERS = 8  # models of a bundle written or read at a time: each is a dozen very small jobs
VERSION_SCHEMA = "name string, version int, path string, alias string"


# ---------------------------------------------------------------- S1
def read_delimited(spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS,
                   rename: dict | None = None, sep: str = ";", missing: str = RAW_MISSING,
                   ts_format: str = RAW_TS_FORMAT, extra_key: str | None = None) -> DataFrame:
    """Explicit all-string schema (no inference), ``missing`` and empty →
    null, ``Date``+``Time`` → TIMESTAMP_NTZ with ``try_to_timestamp``, numeric
    columns by ``try_cast`` (bad values → null). Order is not imposed here
    (windows carry order)."""
    rename = RAW_RENAME if rename is None else rename
    cols = list(columns) + ([extra_key] if extra_key else [])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    raw = (spark.read.schema(schema).option("sep", sep).option("header", "true").option("nullValue", missing)
                .option("emptyValue", None).option("mode", "PERMISSIVE").csv(path))
    # read as UTC and count from the epoch: wall-clock times whatever the session's zone
    instant = f"try_to_timestamp(concat_ws(' ', Date, Time, '+0000'), '{ts_format} xx')"
    ts = F.expr(f"timestampadd(MICROSECOND, unix_micros({instant}), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    nums = [c for c in columns if c not in ("Date", "Time")]
    out = [F.col(extra_key)] if extra_key else []
    out += [ts.alias("datetime")]
    out += [nan_to_null(F.expr(f"try_cast(`{c}` AS double)")).alias(rename.get(c, c)) for c in nums]
    return raw.select(*out)


def write_delimited(df: DataFrame, path: str, ts: str, value_cols: Sequence[str], header: Sequence[str],
                    extra_key: str | None = None, sep: str = ";", missing: str = RAW_MISSING) -> None:
    """Writer for the raw layout (day-first date, ``missing`` for nulls)."""
    cols = [F.concat_ws("/", F.dayofmonth(ts), F.month(ts), F.year(ts)).alias("Date"),
            F.format_string("%02d:%02d:%02d", F.hour(ts), F.minute(ts), F.second(ts)).alias("Time")]
    cols += [F.col(c).cast("string").alias(h) for c, h in zip(value_cols, header)]
    if extra_key:
        cols.append(F.col(extra_key))
    df.select(*cols).write.mode("overwrite").option("sep", sep).option("header", "true") \
      .option("nullValue", missing).csv(path)


# ---------------------------------------------------------------- S2, S3, S6
def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Idempotent Parquet materialisation (a re-run replaces the whole table,
    also the partitions it no longer has, whatever the session's overwrite mode)."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def latest_origin(df: DataFrame, keys=("series_id",), ts="ts") -> DataFrame:
    """Latest available timestamp per series."""
    return df.groupBy(*keys).agg(F.max(ts).alias("as_of"))


# ---------------------------------------------------------------- S5
def write_series_store(df: DataFrame, root: str, keys: Sequence[str] = ("series_id",), ts: str = "ts") -> None:
    """Rows partitioned by day under ``rows``, and each series' last time under ``latest``."""
    rows = df.withColumn("day", F.date_trunc("day", F.col(ts)).cast("date"))
    write_table(rows, f"{root}/rows", ["day"])
    stored = df.sparkSession.read.parquet(f"{root}/rows")
    write_table(latest_origin(stored, keys, ts), f"{root}/latest")


def read_recent(spark: SparkSession, root: str, lookback: int, as_of: DataFrame | None = None, keys: Sequence[str] = ("series_id",), ts: str = "ts",
                step="hour") -> tuple[DataFrame, DataFrame]:
    """(rows, as_of): of each series the rows in [as_of - lookback, as_of], and the
    table of times read for (``latest`` unless given). The days that any of these ranges
    touches become literals, so the scan opens their partitions only, whatever the
    length of the history; a grid is left to the caller."""
    at = as_of if as_of is not None else spark.read.parquet(f"{root}/latest")
    first = add_steps("as_of", -lookback, step)
    days = at.select(F.explode(F.sequence(first.cast("date"), F.col("as_of").cast("date"))).alias("day")).distinct().collect()  # days of the calendar
    rows = spark.read.parquet(f"{root}/rows").where(F.col("day").isin([r.day for r in days]) if days else F.lit(False)).drop("day")
    near = rows.join(at.select(*keys, "as_of"), list(keys)).where((F.col(ts) >= first) & (F.col(ts) <= F.col("as_of")))
    return near.select(rows.columns), at


# ---------------------------------------------------------------- S7, S8
def save_results(df: DataFrame, root: str, result_set: str) -> None:
    """Store one named result set (its partition is replaced on re-run)."""
    (df.withColumn("result_set", F.lit(result_set)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("result_set").parquet(root))


def load_results(spark: SparkSession, root: str, result_set: str | None = None) -> DataFrame:
    """One result set, or all of them with the ``result_set`` column kept
    (method names repeat across sets, so a bare union would mix horizons)."""
    df = spark.read.parquet(root)
    return df.where(F.col("result_set") == result_set) if result_set else df


# ---------------------------------------------------------------- S9, S10
def save_forecasts(df: DataFrame, root: str, step_fmt: str = "yyyy-MM-dd'T'HHmm") -> None:
    """Forecasts partitioned by issue time; re-runs replace only the
    origins they contain (dynamic partition overwrite)."""
    (df.withColumn("origin_key", F.date_format("origin", step_fmt))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("origin_key").parquet(root))


# ---------------------------------------------------------------- S12
def log_run(spark: SparkSession, path: str, run: str, params: dict, metrics: dict) -> None:
    """Append (run, kind, key, value) rows to the run log table."""
    rows = [(run, "param", k, json.dumps(v)) for k, v in params.items()]
    rows += [(run, "metric", k, json.dumps(v)) for k, v in metrics.items()]
    spark.createDataFrame(rows, "run string, kind string, key string, value string") \
         .write.mode("append").parquet(path)


# ---------------------------------------------------------------- S13, S14
def save_bundle(models: dict, path: str, spark: SparkSession, meta: dict) -> None:
    """One Spark ML pipeline directory per horizon plus a one-row metadata table."""
    with ThreadPoolExecutor(max_workers=SAVERS) as ex:
        list(ex.map(lambda h: models[h].write().overwrite().save(f"{path}/model_h{h}"), models))
    spark.createDataFrame([(json.dumps({**meta, "horizons": [str(h) for h in models]}),)], "meta string") \
         .write.mode("overwrite").parquet(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str) -> tuple[dict, dict]:
    meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    with ThreadPoolExecutor(max_workers=SAVERS) as ex:
        models = list(ex.map(lambda h: PipelineModel.load(f"{path}/model_h{h}"), meta["horizons"]))
    return {int(h) if h.isdigit() else h: m for h, m in zip(meta["horizons"], models)}, meta


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a maker of paths on it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def exists(spark: SparkSession, path: str) -> bool:
    fs, make = _files(spark, path)
    return fs.exists(make(path))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, make = _files(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(make(folder))] if fs.exists(make(folder)) else []


def delete_paths(spark: SparkSession, paths: Sequence[str]) -> None:
    for p in paths:
        fs, make = _files(spark, p)
        fs.delete(make(p), True)


def _claim(spark: SparkSession, folder: str) -> bool:
    """Whether this writer alone has claimed a version's folder: it leaves a file of its
    own there and then lists the folder. Whoever writes last sees every claim, so no two
    writers see only their own; one that sees another's takes its claim back."""
    fs, path = _files(spark, folder)
    own = path(f"{folder}/claim-{uuid.uuid4().hex}")
    fs.create(own, False).close()
    if sum(f.getPath().getName().startswith("claim-") for f in fs.listStatus(path(folder))) == 1:
        return True
    fs.delete(own, False)
    return False


def register_version(spark: SparkSession, registry: str, name: str, bundle_path: str, alias: str | None = None, tries: int = 100) -> int:
    """A new version of a model; an alias points at the latest row carrying it.

    Versions are folders ``<registry>/<name>/v=<n>``. A writer claims the number after the
    highest there is, and on a lost claim tries again after a short random wait, so
    concurrent writers get different versions. A claim whose writer failed before writing
    its row leaves a gap in the numbers."""
    if not name or "/" in name or name.startswith((".", "_")):
        raise ValueError(f"not a model name: {name!r}")
    root = f"{registry.rstrip('/')}/{name}"
    fs, path = _files(spark, root)
    if fs.exists(path(registry)) and any(f.isFile() for f in fs.listStatus(path(registry))):
        raise ValueError(f"not a registry of models: {registry}")
    for _ in range(tries):
        taken = [f.getPath() for f in fs.listStatus(path(root))] if fs.exists(path(root)) else []
        held = [int(p.getName()[2:]) for p in taken if p.getName().startswith("v=") and len(fs.listStatus(p))]
        v = max(held, default=0) + 1
        if _claim(spark, f"{root}/v={v}"):
            spark.createDataFrame([(name, v, bundle_path, alias)], VERSION_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/v={v}/row")
            return v
        time.sleep(random.uniform(0.01, 0.2))
    raise RuntimeError(f"no version of {name} could be claimed in {tries} tries")


def read_versions(spark: SparkSession, registry: str) -> DataFrame:
    """Every registered version (name, version, path, alias)."""
    return spark.read.schema(VERSION_SCHEMA).parquet(f"{registry.rstrip('/')}/*/v=*/row")


def resolve_alias(spark: SparkSession, registry: str, name: str, alias: str) -> DataFrame:
    r = read_versions(spark, registry).where((F.col("name") == name) & (F.col("alias") == alias))
    return r.groupBy("name", "alias").agg(F.max_by(F.struct("version", "path"), "version").alias("v")) \
            .select("name", "alias", "v.version", "v.path")


def versions(spark: SparkSession, registry: str) -> DataFrame:
    w = Window.partitionBy("name").orderBy(F.desc("version"))
    return read_versions(spark, registry).withColumn("is_latest", F.row_number().over(w) == 1)
