"""From yearly airport flows to lines and points on a map."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from odskein.operators.extracts import airport_flows, airports_valid
from odskein.operators.yearly import BoundingBox, airport_points, departure_share, pair_points


class YearlyMap(NamedTuple):
    points: DataFrame
    lines: DataFrame


def yearly_map(
    flights: DataFrame,
    airports: DataFrame,
    aircraft_types: DataFrame,
    wef,
    til,
    box: BoundingBox | None = None,
    grain: str = "year",
) -> YearlyMap:
    """Airports in force in the period, and the flows between them with departure totals."""
    flows = airport_flows(
        flights, airports, aircraft_types, wef, til, grain=grain, ordered=False
    )
    points = airport_points(airports_valid(airports, wef, til, ordered=False), box)
    return YearlyMap(points, pair_points(departure_share(flows), points))
