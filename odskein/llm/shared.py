"""Tables and files in the folder that all executors share, and the list of executors' inputs."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own; on a
    cluster that folder would be lost with its machine, so there it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="odskein-llm-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it from there.

    The files outlive any executor, so later work never recomputes what made them, and random or
    task-numbered columns keep the values they were written with.
    """
    return reopened(df.sparkSession, stored_path(df, name), df)


def stored_path(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def reopened(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def drop_paths(spark: SparkSession, *paths: str) -> None:
    """Delete tables or files that no later frame reads."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _memo() -> dict:
    memo = sys.modules.setdefault("odskein_worker_memo", types.ModuleType("odskein_worker_memo"))
    if not hasattr(memo, "kept"):
        memo.kept = {}
    return memo.kept


def worker_memo(key, make: Callable):
    """``make()``, once for each Python worker; its tasks share what it remembers.

    Only what was asked for last is remembered: a worker outlives the job that needed the rest.
    """
    kept = _memo()
    if key not in kept:
        let_go()
        kept[key] = make()
    return kept[key]


def let_go() -> None:
    """Forget what a Python worker remembers of earlier jobs, and give its memory back.

    Tasks that remember nothing begin with this, or an encoder's words would stay beside their arrays.
    """
    kept = _memo()
    if kept:
        kept.clear()
        return_memory()


def return_memory() -> None:
    """Give what a Python worker has freed back to the system.

    The allocator keeps freed arrays of some megabytes for itself, and workers live on from task to
    task, so without this two workers hold the peak of everything they ever did.
    """
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def carried(docs: DataFrame) -> list[Column]:
    """All columns under names of our own (c0, c1, ...), so that they clash with nothing."""
    return [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns)]


def given_back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The carried columns under their former names."""
    return rows.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])
