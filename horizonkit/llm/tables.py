"""Shared Spark helpers of the operators: written intermediate tables, joins
against small decision tables, and Arrow batch functions over texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_path, ship_package

#: A table of at most this many (narrow) rows may be broadcast; beyond it the
#: callers use a shuffle join that gives the same rows.
BROADCAST_ROWS = 500_000
SLICE_BYTES = 4 << 20
TALLY_ROWS = 64  # rows that a task of ``tally`` hands on at most
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: lineage ends there, lost executors cost nothing already written, and
    each later reader scans only the columns it needs. The shuffle files of the write go
    with its end; else they stay on disk until the driver's garbage collector happens on them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has at most BROADCAST_ROWS rows; a
    larger one joins by shuffle, with the same result."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def parts(df: DataFrame) -> int:
    """The session's number of shuffle partitions (set with the data size)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about SLICE_BYTES, as Python objects take several times that."""
    rows = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def release() -> None:
    """Hand freed memory back to the system, Arrow's and that of Python and numpy: a worker
    serves task after task and would else keep about the most that any of them took."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def map_stream(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str, numbers: bool = False) -> DataFrame:
    """``mapInArrow`` with plain column lists: ``fn`` gets {column: list} of each Arrow
    batch of a partition, in order, and yields {column: values} for ``schema``. Columns that
    are all ``numbers``, without nulls, come as arrays."""
    ship_package(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def plain(batches_in):
        for whole in batches_in:
            for b in _slices(whole):
                yield {n: b.column(i).to_numpy(zero_copy_only=False) if numbers else b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
                release()

    def run(batches_in):
        release()  # what an earlier task of this worker left
        for cols in fn(plain(batches_in)):
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in out], schema=out)
        cols = None
        release()  # an idle worker keeps nothing

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, fn: Callable[[dict], Iterator[dict]], schema: str, numbers: bool = False) -> DataFrame:
    """``map_stream`` with each batch on its own."""
    return map_stream(df, lambda stream: (cols for batch in stream for cols in fn(batch)), schema, numbers)


def tally(df: DataFrame, hashes: Callable[[dict], Iterator[np.ndarray]], groups: int) -> np.ndarray:
    """How often the unsigned hashes that ``hashes`` yields for the batches of ``df`` fall on
    each of so many groups (hash modulo ``groups``, a multiple of TALLY_ROWS). A task adds up
    what it reads and hands on its sums as TALLY_ROWS rows of bytes, whatever it has read; the
    sums of the tasks are added row by row, and the driver gets one number a group."""
    size = groups // TALLY_ROWS

    def counted(stream):
        total = np.zeros(groups, np.int64)
        for cols in stream:
            for h in hashes(cols):
                group = (h % np.uint64(groups)).astype(np.int64)
                if len(group) * 8 > groups:
                    total += np.bincount(group, minlength=groups)
                else:
                    group, n = np.unique(group, return_counts=True)
                    total[group] += n
        total = total.reshape(TALLY_ROWS, size)
        some = np.flatnonzero(total.any(axis=1)).tolist()
        at = [np.flatnonzero(total[k]) for k in some]
        yield {"part": some, "at": [x.astype(np.int32).tobytes() for x in at], "n": [total[k][x].tobytes() for k, x in zip(some, at)]}

    def added(stream):
        total = {}
        for cols in stream:
            for k, at, n in zip(cols["part"], cols["at"], cols["n"]):
                total.setdefault(k, np.zeros(size, np.int64))[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.int64)
        yield {"part": list(total), "n": [x.tobytes() for x in total.values()]}

    summed = map_stream(map_stream(df, counted, "part int, at binary, n binary").repartition(TALLY_ROWS, "part"), added, "part int, n binary")
    out = np.zeros((TALLY_ROWS, size), np.int64)
    for row in summed.toArrow().to_pylist():  # TALLY_ROWS at most
        out[row["part"]] = np.frombuffer(row["n"], np.int64)
    return out.ravel()


def without(df: DataFrame, drop: DataFrame, col: str) -> DataFrame:
    """Rows of ``df`` whose ``col`` is not in ``drop`` (null ids stay)."""
    gone = stored(drop.select(col).where(F.col(col).isNotNull()).distinct(), "dropped")
    return df.join(small(gone), col, "left_anti").select(df.columns)
