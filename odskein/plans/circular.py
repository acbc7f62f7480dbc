"""From yearly country flows to the tables of a circular flow chart."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.functions.labels import snake_columns
from odskein.operators.lists import (
    drop_missing_codes,
    visible_countries,
    visible_regions,
    visible_years,
)
from odskein.operators.matrices import year_matrix
from odskein.operators.recode import (
    collapse_regions,
    fix_home_region,
    fix_region,
    merge_flows,
    prepare_columns,
    recode_country,
)
from odskein.operators.regions import split_intra_extra, with_region
from odskein.sinks.files import write_csv, write_parquet
from odskein.sinks.manifests import new_name, publish

EXTRA_FPD = 10
INTRA_FPD = 0


class ChartTables(NamedTuple):
    matrix: DataFrame
    countries: DataFrame
    regions: DataFrame
    years: DataFrame


def clean_flows(raw: DataFrame) -> DataFrame:
    """Codes repaired, rows without a code dropped, columns renamed, merged keys added up.

    ``raw`` may be an extract or the file of one, whose column names are in capitals.
    """
    flows = prepare_columns(drop_missing_codes(recode_country(snake_columns(raw))))
    return merge_flows(flows.withColumn("year", F.col("year").cast("int")), "flights")


def with_un_region(flows: DataFrame, classification: DataFrame, scheme: str = "un_region"):
    """Flows by the regions of the United Nations scheme."""
    return fix_region(with_region(flows, classification, scheme))


def with_home_region(flows: DataFrame, classification: DataFrame, scheme: str = "home_region"):
    """Flows by the regions around the home region."""
    return fix_home_region(with_region(flows, classification, scheme))


def extra_tables(flows: DataFrame, home: str, years: list[int]) -> ChartTables:
    """Flows across the home border, in wide regions. The lists are those before the threshold."""
    extra = collapse_regions(split_intra_extra(flows, home).extra)
    return ChartTables(
        year_matrix(extra, years, EXTRA_FPD),
        visible_countries(extra, show=0),
        visible_regions(extra),
        visible_years(extra),
    )


def intra_tables(
    flows: DataFrame,
    home: str,
    classification: DataFrame,
    years: list[int],
    scheme: str = "sub_region",
) -> ChartTables:
    """Flows inside the home region, by its own parts. The lists are those of the matrix."""
    intra = with_region(split_intra_extra(flows, home).intra, classification, scheme)
    matrix = year_matrix(intra, years, INTRA_FPD)
    return ChartTables(
        matrix,
        visible_countries(matrix, show=1),
        visible_regions(matrix),
        visible_years(intra),
    )


def chart_package(
    prepared: DataFrame, classification: DataFrame, home: str, years: list[int]
) -> dict[str, DataFrame]:
    """The tables of a chart by name, from stored prepared flows."""
    sets = {
        "intra": intra_tables(prepared, home, classification, years),
        "extra": extra_tables(prepared, home, years),
    }
    package = {"flows": prepared}
    for name, tables in sets.items():
        package[f"{name}-flows"] = tables.matrix
        package[f"{name}_countries"] = tables.countries
        package[f"{name}_regions"] = tables.regions
        package[f"{name}_years"] = tables.years
    return package


def write_chart(
    raw: DataFrame,
    classification: DataFrame,
    home: str,
    folder: str,
    years: list[int],
) -> None:
    """Write the prepared flows and both sets of tables under the folder.

    The prepared flows are stored first and read back, so that the tables made from them do not
    repeat the extract behind ``raw``. Each output replaces the former one by itself; a reader who
    must not see two runs mixed reads what ``publish_chart`` wrote.
    """
    prepared = write_parquet(
        with_home_region(clean_flows(raw), classification), f"{folder}/flows.parquet"
    )
    for name, table in chart_package(prepared, classification, home, years).items():
        write_csv(table, f"{folder}/{name}")


def publish_chart(
    raw: DataFrame,
    classification: DataFrame,
    home: str,
    folder: str,
    years: list[int],
) -> int:
    """The same tables as one package, which appears as a whole; returns its number.

    ``published(spark, folder, name)`` reads a table of the last package, whatever a later run that
    is under way or has broken off left behind.
    """
    prepared = write_parquet(
        with_home_region(clean_flows(raw), classification), f"{folder}/{new_name('flows')}"
    )
    return publish(raw.sparkSession, folder, chart_package(prepared, classification, home, years))
