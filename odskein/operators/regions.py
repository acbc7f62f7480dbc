"""Regions from a classification table, and the split of flows around a home region."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odskein.operators.checks import unique_lookup

PREPARED = [
    "year",
    "flights",
    "origin_iso",
    "origin_name",
    "origin_region_name",
    "destination_iso",
    "destination_name",
    "destination_region_name",
]


def with_region(flows: DataFrame, classification: DataFrame, scheme: str) -> DataFrame:
    """Country name and region of both ends; a code the classification lacks gets NULL.

    ``classification`` has ``iso2c``, ``country_name`` and one column per scheme. Names and
    regions that ``flows`` already has are replaced.
    """
    lookup = unique_lookup(classification, "iso2c", ["country_name", scheme])
    keys = flows.drop(*[c for c in PREPARED if c.endswith("_name")])
    for end in ("origin", "destination"):
        side = lookup.select(
            F.col("iso2c").alias(f"{end}_iso"),
            F.col("country_name").alias(f"{end}_name"),
            F.col(scheme).alias(f"{end}_region_name"),
        )
        keys = keys.join(side, f"{end}_iso", "left")
    return keys.select(*PREPARED)


class FlowSplit(NamedTuple):
    """Flows inside the home region, across its border, and passing over it."""

    intra: DataFrame
    extra: DataFrame
    over: DataFrame


def flow_class(home: str) -> Column:
    """``intra``, ``extra`` or ``over``; NULL where a missing region leaves it undecided."""
    origin = F.col("origin_region_name") == home
    destination = F.col("destination_region_name") == home
    return (
        F.when(origin & destination, "intra")
        .when((origin & ~destination) | (~origin & destination), "extra")
        .when(~origin & ~destination, "over")
    )


def split_intra_extra(flows: DataFrame, home: str) -> FlowSplit:
    """Three disjoint parts of the flows; rows with an undecided class are in none of them."""
    kind = flow_class(home)
    return FlowSplit(*[flows.where(kind == part) for part in FlowSplit._fields])


def flow_class_totals(flows: DataFrame, home: str) -> DataFrame:
    """Rows and flights in each class: how much the over-flights and undecided rows amount to."""
    return flows.groupBy(
        F.coalesce(flow_class(home), F.lit("undecided")).alias("flow_class")
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("flights").alias("flights"))
