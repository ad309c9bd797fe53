"""The folder all executors can reach, for tables that cut lineage between stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyward-"))
    return spark.sparkContext.getCheckpointDir()


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    root = _SCRATCH.get() or f"{shared_root(spark)}/tallyward"
    return f"{root}/{uuid.uuid4().hex}/{name}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables cut inside lie in one folder, which is removed at the end."""
    folder = f"{shared_root(spark)}/tallyward/run-{uuid.uuid4().hex}"
    before = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(before)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Files that a task keeps open at once, each with a row group of up to 128 MB; a task with rows of more dumps sorts the rest.
OPEN_FILES = 8


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file per partition open instead of sorting all wide rows of a task; the order within a file is kept only up to ``OPEN_FILES``."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files as they end, at once; for tables whose readers start from the written files."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table other stages read several times, and read it back.

    Survives lost executors, and unlike a cache keeps column pruning and filter
    pushdown for its readers.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut_lean(df: DataFrame, name: str) -> DataFrame:
    """``cut`` for tables with a row per bet: packed tighter, and their shuffle files go as they are written, so that stages don't add up on disk."""
    folder = new_folder(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of finished jobs now: its cleaner waits until the driver's JVM next collects what refers to them."""
    spark.sparkContext._jvm.System.gc()
