"""Extracts kept on shared storage: one folder per period, or one table with a folder per day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from odskein.functions.period import Period
from odskein.sinks.manifests import current, publish, published

EXTRACT = "extract"


def period_path(template: str, period: Period) -> str:
    """Fill ``{wef}`` and ``{til}`` of a path with the period's days."""
    return template.format(
        wef=period.wef.strftime("%Y-%m-%d"), til=period.til.strftime("%Y-%m-%d")
    )


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool = False
) -> DataFrame:
    """The table stored at the path, extracted and stored first if there is none.

    An extract that broke off midway was never committed and is built again; one that is refreshed
    takes the place of the former at once. The result always reads stored files, so what follows
    never repeats the extract.
    """
    if refresh or EXTRACT not in current(spark, path)[1]:
        publish(spark, path, {EXTRACT: build()})
    return published(spark, path, EXTRACT)


def write_days(
    df: DataFrame, path: str, day: str = "entry_day", spread: tuple[str, ...] = ("adep", "ades")
) -> None:
    """Store an extract in a table partitioned by day, in place of the days it already holds.

    Rows are ranged over the day and the ``spread`` columns: a day is written by a few tasks, a
    busy one by more.
    """
    (
        df.repartitionByRange(day, *spread)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def read_period(
    spark: SparkSession, path: str, period: Period, day: str = "entry_day"
) -> DataFrame:
    """The days of a period from such a table; folders of other days are not opened."""
    days = spark.read.parquet(path)
    return days.where(period.holds(days, day))
