"""Intermediate tables and folders that every executor and the driver can reach, and memory of Python workers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; if unset, one under the session's warehouse."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_waybill"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Queries built and run inside lose their shuffle files with their last job, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, its shuffles then removed; Spark removes the files with the last reference if it is set to."""
    shared_folder(df.sparkSession)
    with _without_shuffle_files(df.sparkSession):
        return df.select("*").checkpoint()


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as compressed Parquet in the shared folder, its shuffles then removed, and read again."""
    path = new_folder(df.sparkSession, name)
    with _without_shuffle_files(df.sparkSession):
        df.select("*").write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give the memory that this process has freed back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(body: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A ``mapInArrow`` body that ends with ``release``.

    Spark reuses Python workers, and idle ones would hold what their largest task had taken beside the
    shuffles and sorts that follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from body(batches)
        finally:
            release()

    return run


def lean_group(body: Callable[[pa.Table], pa.Table]) -> Callable:
    """An ``applyInArrow`` function that ends with ``release``, as ``lean``."""

    def run(table: pa.Table) -> pa.Table:
        out = body(table)
        release()
        return out

    return run
