"""What the operators share: module paths for Python workers and shared scratch tables."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when they start with this session's environment.

    On a cluster that does not share the driver's files, submit the package with --py-files.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or a local one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file:///tmp/checkpoints"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/termsieve/{name}-{uuid.uuid4().hex}"


def fleeting(spark: SparkSession, path: str) -> None:
    """Have the driver delete a path when it ends; it must exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    fleeting(spark, path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path  # type: ignore[attr-defined]
    return back


def discard(spark: SparkSession, tables: Iterable[DataFrame | str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for t in tables:
        path = t if isinstance(t, str) else getattr(t, "scratch", None)
        if path:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task function around which the worker gives the memory that it has freed back to the machine.

    Before it, because Spark takes an earlier task's broadcast values out only when the next task begins.
    """

    def give_back() -> None:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
            ctypes.CDLL(None).malloc_trim(0)

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def add_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of rows (rows, df): numbers of rows, and vectors of 64-bit counts as bytes."""
    rows, df = 0, None
    for batch in batches:
        for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(raw, "<i8")
            rows, df = rows + n, own.copy() if df is None else df + own
    if df is not None:
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([df.tobytes()], pa.binary())], ["rows", "df"])


def summed(parts: DataFrame) -> tuple[int, np.ndarray | None]:
    """The sum of a table (rows, df) with a row per partition, by a tree of tasks that add up to 64 vectors each."""
    n = parts._jdf.queryExecution().executedPlan().outputPartitioning().numPartitions()
    while n > 16:
        n = -(-n // 64) if n > 1024 else 16
        parts = parts.repartition(n).mapInArrow(add_vectors, "rows long, df binary")
    rows, df = 0, None
    for r in parts.collect():  # at most 16 vectors of fixed length
        own = np.frombuffer(bytes(r["df"]), "<i8")
        rows, df = rows + r["rows"], own.copy() if df is None else df + own
    return rows, df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(taken: Iterable[str], base: str) -> str:
    """A column name that clashes with none of the taken ones, whatever their case."""
    used = {c.lower() for c in taken}
    while base.lower() in used:
        base = f"_{base}"
    return base
