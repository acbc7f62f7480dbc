"""Key checks: duplicated keys as data, and a lookup that refuses to hold any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def unique_lookup(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``key`` with ``values``, one row per key; a repeated key fails the query that reads it.

    A repeated key would multiply the rows joined to it. The check is part of the plan, so it
    costs no separate job.
    """
    one = F.min(F.struct(*values))
    checked = F.when(
        F.count(F.lit(1)) > 1,
        F.raise_error(F.concat(F.lit(f"lookup has several rows for {key} "), F.col(key))),
    ).otherwise(one)
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(checked.alias("_row"))
        .select(key, *[F.col("_row")[v].alias(v) for v in values])
    )


def sorted_values(df: DataFrame, column: str) -> list:
    """The distinct non-null values of a column as a sorted driver list, for naming columns.

    Meant for dimensions: the values become the columns of a wide table, which bounds them. The
    long form of the data needs no such list.
    """
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(row[0] for row in rows)


def listed(column: Column, values: list, what: str) -> Column:
    """The column's value, if it is one of ``values`` or missing; any other fails the query."""
    return F.when(column.isNull() | column.isin(list(values)), column).otherwise(
        F.raise_error(F.concat(F.lit(f"{what} is not in the list: "), column.cast("string")))
    )
