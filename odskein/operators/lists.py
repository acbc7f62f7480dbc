"""Lists of the countries, regions, years and days in a set of flows, and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.functions.labels import in_order
from odskein.functions.nulls import if_known
from odskein.session import in_utc


def visible_countries(flows: DataFrame, show: int, collation: str | None = None) -> DataFrame:
    """Countries at either end, with a flag that says whether a chart shows them at first.

    Both ends come out of one pass over the flows. With a collation the list is in the order of names,
    without one in that of codes.
    """
    ends = F.array(
        *[
            F.struct(F.col(f"{end}_iso").alias("iso"), F.col(f"{end}_name").alias("name"))
            for end in ("destination", "origin")
        ]
    )
    return (
        flows.select(F.inline(ends))
        .distinct()
        .orderBy(*([] if collation is None else in_order("name", collation)), *in_order("iso"), *in_order("name"))
        .withColumn("show", F.lit(show))
    )


def visible_regions(flows: DataFrame, collation: str | None = None) -> DataFrame:
    """Regions at either end, in byte order or that of a collation."""
    ends = F.array("destination_region_name", "origin_region_name")
    names = flows.select(F.explode(ends).alias("name")).distinct()
    return names.orderBy(*in_order("name", collation))


def visible_years(flows: DataFrame) -> DataFrame:
    """Years with flows."""
    return flows.select("year").distinct().orderBy(F.asc_nulls_last("year"))


@in_utc
def day_list(flows: DataFrame, day: str = "entry_day") -> DataFrame:
    """One row with the days that have flows, newest first, separated by commas.

    The days are made distinct before they are gathered: the calendar bounds the list.
    """
    days = flows.select(F.to_date(day).cast("string").alias("day")).distinct()
    newest_first = F.sort_array(F.collect_set("day"), asc=False)
    return days.agg(F.array_join(newest_first, ",").alias("value"))


def top_contributors(matrix: DataFrame, column: str, home: str, n: int = 30) -> DataFrame:
    """The ``n`` countries with the largest total in one column of a year matrix.

    A flow counts for its origin, unless the origin is the home region as a whole.
    """
    label = if_known(
        F.col("origin_region_name") != home, F.col("origin_name"), F.col("destination_name")
    )
    return (
        matrix.groupBy(label.alias("flow"))
        .agg(F.sum(column).alias("total"))
        .orderBy(F.desc_nulls_last("total"), F.asc_nulls_last("flow"))
        .limit(n)
    )


def missing_code_audit(
    flows: DataFrame,
    origin: str = "dep_iso_country_code",
    destination: str = "des_iso_country_code",
    measure: str = "nb_of_flight",
) -> DataFrame:
    """Flights on rows where either code is missing, by the two codes."""
    missing = F.col(origin).isNull() | F.col(destination).isNull()
    return (
        flows.where(missing).groupBy(origin, destination).agg(F.sum(measure).alias("filtered_out"))
    )


def missing_code_totals(
    flows: DataFrame,
    origin: str = "dep_iso_country_code",
    destination: str = "des_iso_country_code",
    measure: str = "nb_of_flight",
) -> DataFrame:
    """One row: flights without a departure code, and without a destination code; 0 if none."""

    def total(code: str):
        return F.coalesce(F.sum(F.when(F.col(code).isNull(), F.col(measure))), F.lit(0))

    return flows.agg(
        total(origin).alias("filtered_out_dep"), total(destination).alias("filtered_out_des")
    )


def drop_missing_codes(
    flows: DataFrame,
    origin: str = "dep_iso_country_code",
    destination: str = "des_iso_country_code",
) -> DataFrame:
    """Rows that have both codes."""
    return flows.na.drop(subset=[origin, destination])
