"""Repairs of country codes, names and regions on origin/destination flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odskein.functions.nulls import if_known

# Codes retired or misused in the source, and the regions that classifications
# leave out or split more finely than the charts do.
COUNTRY_CODES = {"CS": "RS", "XF": "MQ"}
UN_REGIONS = {"AN": "Caribbean", "TW": "Eastern Asia", "IO": "Eastern Africa"}
HOME_REGIONS = {
    "AN": "Southern America",
    "TW": "Eastern Asia",
    "IO": "Eastern Africa",
    "SN": "Western Africa",
}
HOME_NAMES = {"AN": "Antilles"}
WIDE_REGIONS = {
    "Russia": "Asia",
    "China": "Asia",
    "Southern America": "America",
    "Northern America": "America",
}

ENDS = ("origin", "destination")


def recode_country(
    flows: DataFrame,
    codes: dict[str, str] = COUNTRY_CODES,
    columns: tuple[str, str] = ("dep_iso_country_code", "des_iso_country_code"),
) -> DataFrame:
    """Replace country codes on both ends, row by row.

    Two rows can come to share a key; ``merge_flows`` adds them up.
    """
    return flows.replace(codes, subset=list(columns))


def merge_flows(flows: DataFrame, measure: str) -> DataFrame:
    """Add up the measure of rows that agree on every other column."""
    keys = [name for name in flows.columns if name != measure]
    return flows.groupBy(*keys).agg(F.sum(measure).alias(measure)).select(*flows.columns)


def prepare_columns(flows: DataFrame) -> DataFrame:
    """The column names of the extract become those of the prepared flows."""
    return flows.withColumnsRenamed(
        {
            "nb_of_flight": "flights",
            "dep_iso_country_code": "origin_iso",
            "des_iso_country_code": "destination_iso",
        }
    )


def fix_region(flows: DataFrame, regions: dict[str, str] = UN_REGIONS) -> DataFrame:
    """Set the region of the listed country codes on both ends.

    Where the code is missing the region becomes NULL: the rule cannot be decided.
    """
    return flows.withColumns(
        {f"{end}_region_name": _by_code(end, "region_name", regions) for end in ENDS}
    )


def fix_home_region(
    flows: DataFrame,
    regions: dict[str, str] = HOME_REGIONS,
    names: dict[str, str] = HOME_NAMES,
) -> DataFrame:
    """Set region and, for some, name of the codes the home classification leaves out."""
    named = {f"{end}_name": _by_code(end, "name", names) for end in ENDS}
    return fix_region(flows, regions).withColumns(named)


def collapse_regions(flows: DataFrame, regions: dict[str, str] = WIDE_REGIONS) -> DataFrame:
    """Fold regions into wider ones on both ends."""
    return flows.replace(regions, subset=[f"{end}_region_name" for end in ENDS])


def _by_code(end: str, attribute: str, rules: dict[str, str]) -> Column:
    value = F.col(f"{end}_{attribute}")
    for code, replacement in rules.items():
        value = if_known(F.col(f"{end}_iso") == code, replacement, value)
    return value
