"""From daily airport flows to the tables of an origin/destination map with a timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame

from odskein.operators.flowmap import (
    ITS_COUNTRY,
    MISPLACED_AIRPORT,
    country_pairs,
    flow_timeline,
    locations,
    repair_country,
)
from odskein.operators.lists import day_list
from odskein.sinks.files import (
    map_properties,
    write_csv,
    write_days,
    write_locations,
    write_parquet,
    write_timeline,
)
from odskein.sinks.manifests import new_name, publish

# The airport the source places in the wrong country.
DEFAULT_REPAIR = (MISPLACED_AIRPORT, ITS_COUNTRY)


def _pairs(daily: DataFrame, repair: tuple[str, str] | None) -> DataFrame:
    return country_pairs(repair_country(daily, *repair) if repair else daily)


def map_timeline(
    daily: DataFrame,
    centroids: DataFrame,
    extra: DataFrame | None = None,
    overrides: DataFrame | None = None,
    threshold: int = 1,
    ordered: bool = True,
    repair: tuple[str, str] | None = DEFAULT_REPAIR,
) -> DataFrame:
    """The timeline of the country pairs behind daily airport flows, as one lazy frame.

    ``repair`` is an airport and the country code to give it; None leaves the codes alone.
    """
    pairs = _pairs(daily, repair)
    places = locations(pairs, centroids, extra, overrides)
    return flow_timeline(pairs, places, threshold, ordered)


def write_map(
    daily: DataFrame,
    centroids: DataFrame,
    folder: str,
    threshold: int = 1,
    by_day: bool = False,
    extra: DataFrame | None = None,
    overrides: DataFrame | None = None,
    repair: tuple[str, str] | None = DEFAULT_REPAIR,
    **publisher: str | None,
) -> None:
    """Write pairs, locations, timeline, day list and properties under the folder.

    Pairs and locations are stored and read back by the tables made from them.
    """
    pairs = write_parquet(_pairs(daily, repair), f"{folder}/pairs.parquet")
    places = write_parquet(locations(pairs, centroids, extra, overrides), f"{folder}/locations.parquet")
    timeline = flow_timeline(pairs, places, threshold, ordered=False)
    write_locations(places, f"{folder}/locations")
    write_timeline(timeline, f"{folder}/flows")
    if by_day:
        write_days(timeline, f"{folder}/days")
    write_csv(day_list(timeline, "time"), f"{folder}/day_list")
    write_csv(map_properties(daily.sparkSession, **publisher), f"{folder}/properties")


def publish_map(
    daily: DataFrame,
    centroids: DataFrame,
    folder: str,
    threshold: int = 1,
    extra: DataFrame | None = None,
    overrides: DataFrame | None = None,
    repair: tuple[str, str] | None = DEFAULT_REPAIR,
    **publisher: str | None,
) -> int:
    """The same tables as one package, which appears as a whole; returns its number.

    The timeline carries its day, so a reader of single days filters it.
    """
    run = f"{folder}/{new_name('pairs')}"
    pairs = write_parquet(_pairs(daily, repair), f"{run}/pairs")
    places = write_parquet(locations(pairs, centroids, extra, overrides), f"{run}/locations")
    timeline = write_parquet(flow_timeline(pairs, places, threshold), f"{run}/flows")
    package = {
        "locations": places.drop("iso_a2"),
        "flows": timeline,
        "day_list": day_list(timeline, "time"),
        "properties": map_properties(daily.sparkSession, **publisher),
    }
    return publish(daily.sparkSession, folder, package)
