"""Tables and packages that change as one.

A commit is one row added to a manifest table: its number and, for each part, the folder that holds
it (relative, so that a table can be moved). Folders are written before the commit and never changed
after it, so a reader sees the state before or after, and a run that breaks off leaves only folders
that no manifest names. One writer at a time: a commit states which one it follows, and one that
follows an old commit is refused.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "number bigint, parts map<string,string>"


def new_name(what: str) -> str:
    """A folder name that nothing was written to yet."""
    return f"{what}-{uuid.uuid4().hex}"


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """All commits of a folder; no rows if there is none yet."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{folder}/_commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def current(spark: SparkSession, folder: str, number: int | None = None) -> tuple[int, dict[str, str]]:
    """The last commit (or the one with that number) and its parts; (0, {}) before the first."""
    rows = commits(spark, folder)
    if number is not None:
        rows = rows.where(F.col("number") == number)
    last = rows.orderBy(F.desc("number")).limit(1).collect()
    if not last and number is not None:
        raise ValueError(f"{folder} has no commit {number}")
    return (last[0]["number"], last[0]["parts"]) if last else (0, {})


def commit(spark: SparkSession, folder: str, parts: dict[str, str], after: int) -> int:
    """Name the parts that now make up the folder; ``after`` is the commit they are based on.

    The row is one file, which Spark's committer moves into place whole.
    """
    if current(spark, folder)[0] != after:
        raise RuntimeError(f"{folder} was committed to meanwhile; start again from its last commit")
    row = spark.createDataFrame([(after + 1, parts)], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{folder}/_commits")
    return after + 1


def publish(spark: SparkSession, folder: str, tables: dict[str, DataFrame]) -> int:
    """Write tables of one run and make them the folder's package; returns the commit's number."""
    after, _ = current(spark, folder)
    run = new_name("run")
    for name, frame in tables.items():
        frame.write.parquet(f"{folder}/{run}/{name}")
    return commit(spark, folder, {name: f"{run}/{name}" for name in tables}, after)


def published(spark: SparkSession, folder: str, name: str, number: int | None = None) -> DataFrame:
    """One table of the package as last committed, or as committed under a number."""
    _, parts = current(spark, folder, number)
    if name not in parts:
        raise ValueError(f"{folder} holds no published table {name!r}, but {sorted(parts)}")
    return spark.read.parquet(f"{folder}/{parts[name]}")
