"""Wide tables: one column per year, or one column per destination."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odskein.functions.labels import sorted_label
from odskein.operators.checks import listed

PAIR_KEYS = [
    "origin_iso",
    "origin_name",
    "origin_region_name",
    "destination_iso",
    "destination_name",
    "destination_region_name",
]
DAYS_PER_YEAR = 365
# A float stands for the nearest fraction with at most this denominator.
FINEST = 1_000_000


def yearly_limit(fpd: int | float | Fraction | Decimal | str) -> Fraction:
    """Flights a day as exact flights a year.

    In floats, 365 times 12/365 is less than 12, so a comparison with it would count a yearly total
    of 12 as above the threshold. A float is taken as the fraction it was written as: 12/365, not
    the binary number next to it.
    """
    exact = Fraction(fpd)
    if isinstance(fpd, float):
        exact = exact.limit_denominator(FINEST)
    return DAYS_PER_YEAR * exact


def above_limit(total: str, kind: str, limit: Fraction) -> Column:
    """Whether a total is above the limit; exact for whole numbers of any size."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(total) > F.lit(limit.numerator // limit.denominator)
    return F.col(total) * F.lit(limit.denominator) > F.lit(limit.numerator)


def year_matrix(
    flows: DataFrame,
    years: list[int],
    fpd: int | float | Fraction | Decimal | str = 0,
    keys: list[str] = PAIR_KEYS,
    prefix: str = "countryflow_",
) -> DataFrame:
    """One row per pair and one column per year, keeping cells above ``fpd`` flights a day.

    The comparison is strict and exact, see ``yearly_limit``. A cell at or below the threshold, or without flights, shows 0, and
    a pair with no cell above it has no row. Repeated rows are added up before the comparison.
    A year outside ``years``, or none, has no column to go to and fails the query; filter the
    flows first where only some years are wanted.

    Totals, threshold and pivot are one grouping with a conditional sum per year: one shuffle,
    combined before it.
    """
    if not years:
        return flows.select(*keys).limit(0)
    limit = yearly_limit(fpd)
    names = [f"{prefix}{year}" for year in years]
    totals = (
        _with_listed_year(flows, years)
        .groupBy(*keys)
        .agg(*[_year_total(y, "flights").alias(n) for y, n in zip(years, names)])
    )
    above = {n: above_limit(n, totals.schema[n].dataType.simpleString(), limit) for n in names}
    kept = reduce(lambda a, b: a | b, above.values(), F.lit(False))
    return totals.where(kept).select(
        *keys, *[F.when(above[n], F.col(n)).otherwise(0).alias(n) for n in names]
    )


def pair_totals_by_year(
    flows: DataFrame, years: list[int], collation: str | None = None
) -> DataFrame:
    """Movements per year between two regions, both directions under one name.

    The name has the smaller region first, in byte order or that of a collation.

    A year outside ``years``, or none, fails the query.
    """
    label = sorted_label(F.col("origin_region_name"), F.col("destination_region_name"), collation)
    if not years:
        return flows.select(label.alias("flow_name")).limit(0)
    return (
        _with_listed_year(flows, years)
        .groupBy(label.alias("flow_name"))
        .agg(*[F.coalesce(_year_total(y, "flights"), F.lit(0)).alias(str(y)) for y in years])
    )


def region_pair_stats(flows: DataFrame, collation: str | None = None) -> DataFrame:
    """The long form of ``pair_totals_by_year``, largest movements first."""
    label = sorted_label(F.col("origin_region_name"), F.col("destination_region_name"), collation)
    return (
        flows.groupBy("year", label.alias("flow_name"))
        .agg(F.sum("flights").alias("movements"))
        .orderBy(F.desc_nulls_last("movements"), "year", "flow_name")
    )


def od_matrix(
    flows: DataFrame,
    destinations: list[str],
    origin: str = "origin_iso",
    destination: str = "destination_iso",
    measure: str = "flights",
    missing: str = "missing",
) -> DataFrame:
    """One row per origin, one column per destination, 0 where nothing flows.

    Flows without a destination are in the column ``missing``, flows without an origin in the row
    of the NULL origin. A destination outside the list fails the query, so a row adds up to all
    that leaves its origin. Spark's pivot adds up per pair before it gathers an origin's row, so a
    busy origin is one row per destination by then.
    """
    if missing in destinations:
        raise ValueError(f"{missing!r} is a destination; name the column of missing ones otherwise")
    columns = [*destinations, missing]
    to = F.coalesce(listed(F.col(destination), destinations, destination), F.lit(missing))
    wide = (
        flows.select(origin, to.alias("_to"), measure)
        .groupBy(origin)
        .pivot("_to", columns)
        .agg(F.sum(measure))
    )
    return wide.na.fill(0, subset=columns)


def _with_listed_year(flows: DataFrame, years: list[int]) -> DataFrame:
    year = F.coalesce(F.col("year").cast("int"), F.lit(-1))
    return flows.withColumn("year", listed(year, [int(y) for y in years], "year"))


def _year_total(year: int, measure: str) -> Column:
    return F.sum(F.when(F.col("year").cast("int") == int(year), F.col(measure)))
