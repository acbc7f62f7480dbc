"""Tables with one partition per day, of which single days are replaced or added to.

A load writes its days to a folder of its own, ``load=<name>/<day column>=<day>``. The manifest says
which loads make up a day. Replacing a day names the new load instead of the old ones, adding to it
names the new load as well; either takes effect for all days at once, when the commit is written.
Readers prune to the folders named, so neither a load under way nor a replaced one is read.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odskein.functions.period import Period
from odskein.sinks.manifests import commit, current, new_name

LOAD = "load"


def days_in(rows: DataFrame, day: str) -> list[date]:
    """The different days of a date column: a calendar's worth at most, so they go to the driver."""
    return sorted(row[0] for row in rows.select(day).where(F.col(day).isNotNull()).distinct().collect())


def write_load(rows: DataFrame, folder: str, day: str) -> str:
    """Write the rows as a load that no manifest names yet; rows without a day are an error.

    Rows of a day come together, and AQE splits a busy day and joins quiet ones, so files are few and
    of even size without a pass over the rows that only finds ranges.
    """
    load = new_name("load")
    named = F.coalesce(F.col(day), F.raise_error(F.lit(f"a row of the load has no {day}")).cast("date"))
    dealt = rows.withColumn(day, named).hint("rebalance", F.col(day))
    dealt.write.partitionBy(day).parquet(f"{folder}/{LOAD}={load}")
    return load


def replace_days(
    rows: DataFrame,
    folder: str,
    days: list[date],
    day: str = "entry_day",
    notes: dict[str, str] | None = None,
) -> int:
    """Make ``rows`` the content of the given days; a day without rows is then empty.

    ``notes`` are entries for the manifest besides the days; their names begin with ``_``.
    """
    spark = rows.sparkSession
    number, parts = current(spark, folder)
    load = write_load(rows, folder, day)
    written = days_of_load(spark, folder, load, day)
    if strange := set(written) - set(days):
        raise ValueError(f"rows of days that are not to be replaced: {sorted(map(str, strange))}")
    gone = set(map(str, days))
    kept = {name: loads for name, loads in parts.items() if name not in gone}
    return commit(spark, folder, {**kept, **{str(d): load for d in written}, **(notes or {})}, number)


def add_to_days(
    rows: DataFrame,
    folder: str,
    day: str = "entry_day",
    notes: dict[str, str] | None = None,
) -> int:
    """Add rows to the days they belong to."""
    spark = rows.sparkSession
    number, parts = current(spark, folder)
    load = write_load(rows, folder, day)
    for name in map(str, days_of_load(spark, folder, load, day)):
        parts[name] = f"{parts[name]} {load}" if name in parts else load
    return commit(spark, folder, {**parts, **(notes or {})}, number)


def days_of_load(spark: SparkSession, folder: str, load: str, day: str) -> list[date]:
    """The days a load has rows of, from its folders."""
    return days_in(spark.read.schema(f"{day} date").parquet(f"{folder}/{LOAD}={load}"), day)


def read_days(
    spark: SparkSession, folder: str, schema: str, period: Period | None = None, day: str = "entry_day", number: int | None = None
) -> DataFrame:
    """The table (``schema`` with the day column) as of the last commit, or of a former one.

    Folders of other days, and of loads that a day no longer has, are not opened.
    """
    return days_of(spark, folder, schema, current(spark, folder, number)[1], period, day)


def days_of(spark: SparkSession, folder: str, schema: str, parts: dict[str, str], period: Period | None = None, day: str = "entry_day") -> DataFrame:
    """The rows of the days and loads that a manifest's parts name."""
    of: dict[str, list[date]] = {}
    for name, loads in parts.items():
        if not name.startswith("_"):
            for load in loads.split():
                of.setdefault(load, []).append(date.fromisoformat(name))
    if not of:
        return spark.createDataFrame([], schema)
    names = spark.createDataFrame([], schema).columns
    paths = [f"{folder}/{LOAD}={load}" for load in sorted(of)]
    rows = spark.read.schema(f"{schema}, {LOAD} string").option("basePath", folder).parquet(*paths)
    named = [(F.col(LOAD) == load) & F.col(day).isin(sorted(days)) for load, days in sorted(of.items())]
    rows = rows.where(reduce(lambda a, b: a | b, named))
    if period is not None:
        rows = rows.where(period.holds(rows, day))
    return rows.select(*names)
