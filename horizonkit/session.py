"""Spark session helpers.

The library never relies on the session time zone for its own arithmetic
(see ``functions.timecols``), but sessions it creates use UTC, ANSI mode and
AQE so that plans behave the same locally and on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "horizonkit", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors (once per application), so that Python
    functions run wherever the driver was started and nothing need be installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="horizonkit-"), "horizonkit.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read.
    When it is unset in local mode (tests, a laptop) a folder is created under
    ``fallback`` (default: the system temp folder) and registered. On a cluster
    an unset folder is an error: executors would each write to their own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if fallback is None and not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), "horizonkit-ckpt")
        d = os.path.join(base, uuid.uuid4().hex)
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage once for an input reused by several branches of a plan
    (e.g. a grid feeding bounds, look-ups and actuals): a reliable checkpoint
    in the shared checkpoint folder, so the raw source is scanned once and a
    lost executor does not force recomputation from the raw tables."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
