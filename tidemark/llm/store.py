"""Where intermediate tables go: the shared folder that the session names."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where the session names none, a local session gets a temporary one (tests); on a cluster that is an error."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not at:
        ready = sc._jsc.sc().getCheckpointDir()
        if not ready.isDefined() and not (sc.master.startswith("local[") or sc.master == "local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        at = ready.get() if ready.isDefined() else tempfile.mkdtemp(prefix="spark-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: later reads survive lost executors and don't repeat the work."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stash(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """The same rows as a Parquet table in the shared folder, with sizes that the optimizer can see.

    Where rows are blocks of some MB, `group_rows` is how many of them a row group holds: Parquet's writer looks at its size only every hundred rows, and its reader decodes a row group
    at once, so by default a task would hold a hundred blocks.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.option("parquet.block.row.count.limit", group_rows) if group_rows else df.write).parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def one_row_batches(spark: SparkSession):
    """While rows are blocks of some MB, a task gets them one at a time, so that what it holds doesn't grow with its partition. What runs inside has to be written there."""
    return _set(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1")


def small_batches(spark: SparkSession, size: int = 4 << 20):
    """While rows are whole texts, a task gets about `size` bytes of them at a time, however long they are. What runs inside has to be written there."""
    return _set(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def give_back() -> None:
    """Freed memory goes back to the system, where its C library can; else a worker, which outlives its tasks, holds what its largest step took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(f: Callable) -> Callable:
    """A function for mapInArrow that gives memory back when its partition ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        give_back()

    return run


def frugal_group(f: Callable) -> Callable:
    """A function for applyInArrow that gives memory back after each group."""

    def run(table: pa.Table) -> pa.Table:
        out = f(table)
        give_back()
        return out

    return run
