"""Yearly airport map: totals per departure airport and airports as points."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.operators.lookups import with_totals


class BoundingBox(NamedTuple):
    west: float
    south: float
    east: float
    north: float


# Continental Europe.
EUROPE = BoundingBox(-25, 29, 45, 75)


def departure_share(flows: DataFrame) -> DataFrame:
    """Airport flows without circular flights, with the total of their departure airport.

    The totals are an aggregate joined back: combined before the shuffle and one row per
    airport, where a window would gather all rows of a busy airport in one task. The join can be
    split where an airport is busy, see ``with_totals``.
    """
    direct = flows.where(F.col("adep") != F.col("ades")).withColumnRenamed("nb_of_flight", "n")
    totals = direct.groupBy("adep").agg(F.sum("n").alias("total"))
    return with_totals(direct, totals, ["adep"]).select(*direct.columns, "total")


def region_countries(
    countries: DataFrame, region: str = "Europe", without: tuple[str, ...] = ("Russia",)
) -> DataFrame:
    """The countries of a region that the map shows."""
    return countries.where((F.col("region") == region) & ~F.col("name").isin(list(without)))


def airport_points(airports: DataFrame, box: BoundingBox | None = None) -> DataFrame:
    """Airports with a position, inside the box if one is given (its edges included)."""
    placed = airports.na.drop(subset=["longitude", "latitude"])
    if box is not None:
        placed = placed.where(
            F.col("longitude").between(box.west, box.east)
            & F.col("latitude").between(box.south, box.north)
        )
    return placed


def pair_points(pairs: DataFrame, airports: DataFrame) -> DataFrame:
    """Airport pairs with the position of both ends; a pair with an unknown airport drops out."""
    points = airports.select("icao", "longitude", "latitude")
    return pairs.join(points.toDF("adep", "adep_longitude", "adep_latitude"), "adep").join(
        points.toDF("ades", "ades_longitude", "ades_latitude"), "ades"
    ).select(
        *pairs.columns, "adep_longitude", "adep_latitude", "ades_longitude", "ades_latitude"
    )


def clip_lines(lines: DataFrame, box: BoundingBox) -> DataFrame:
    """The part of each straight line (in degrees) that lies in the box; lines outside drop out.

    The columns are those of ``pair_points``. Along a line, a place is a number from 0 (departure) to
    1 (destination). Each side of the box is entered or left at one such number; the part inside
    lies between the last entry and the first exit. A line that only touches the box keeps the one
    point; a line with an end that has no position drops out.
    """
    x, y = F.col("adep_longitude"), F.col("adep_latitude")
    dx, dy = F.col("ades_longitude") - x, F.col("ades_latitude") - y
    # for each side: how fast the line leaves through it, and how far its start is inside
    sides = [
        (-dx, x - F.lit(float(box.west))),
        (dx, F.lit(float(box.east)) - x),
        (-dy, y - F.lit(float(box.south))),
        (dy, F.lit(float(box.north)) - y),
    ]
    entered = F.greatest(F.lit(0.0), *[F.when(speed < 0, room / speed) for speed, room in sides])
    left = F.least(F.lit(1.0), *[F.when(speed > 0, room / speed) for speed, room in sides])
    outside = reduce(or_, [(speed == 0) & (room < 0) for speed, room in sides])
    known = reduce(and_, [F.col(f"{end}_{axis}").isNotNull() for end in ("adep", "ades") for axis in ("longitude", "latitude")])
    inside = lines.where(known & ~outside).withColumns({"_in": entered, "_out": left}).where(F.col("_in") <= F.col("_out"))
    places = {}
    for end, at in (("adep", F.col("_in")), ("ades", F.col("_out"))):
        for axis, start, step in (("longitude", x, dx), ("latitude", y, dy)):
            whole = F.col(f"{end}_{axis}")
            uncut = at == (0.0 if end == "adep" else 1.0)
            places[f"{end}_{axis}"] = F.when(uncut, whole).otherwise(start + at * step)
    return inside.withColumns(places).drop("_in", "_out")
