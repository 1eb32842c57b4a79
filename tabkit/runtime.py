"""Shared folder for staged data and checkpoints."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 50_000

_RUN: ContextVar[str | None] = ContextVar("tabkit_run", default=None)
_OWNED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches, as named by ``spark.checkpoint.dir``.

    A session without that setting gets a temporary folder, but only in local mode, where driver and
    executors share one machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tabkit-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    """The application's folder for intermediate results, deleted when the driver's Python ends."""
    path = f"{shared_dir(spark).rstrip('/')}/tabkit/{spark.sparkContext.applicationId}"
    if path not in _OWNED:
        _OWNED.add(path)
        atexit.register(_delete_quietly, spark, path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, inside the shared folder; in ``scratch`` inside the folder that it deletes, else in one that goes
    with the application."""
    return f"{_RUN.get() or _own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def table_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet for a table that outlives the application."""
    return f"{shared_dir(spark).rstrip('/')}/tabkit/tables/{name}-{uuid.uuid4().hex}"


def _delete_quietly(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the JVM may be gone
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's own file systems, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Own what the steps inside store: it is deleted at the end, so write or collect results before."""
    path = f"{shared_dir(spark).rstrip('/')}/tabkit/run-{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        delete(spark, path)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    What follows starts from stored columns: nothing before is computed twice or again after a lost executor,
    later passes read only the columns they use, and the optimizer has a short plan to work on. The files stay until
    the ``scratch`` around the call ends, or the application without one.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # a known schema spares a job over the files


def spread(df: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """The frame dealt evenly to all cores, or to a task per so many rows if that is fewer, where its files would leave it to fewer tasks.

    For stored frames that many passes read: a file with one row group is one task of every pass else. Rows are dealt in turn, not by a key.
    """
    n = min(df.sparkSession.sparkContext.defaultParallelism, df.count() // rows + 1)
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)
