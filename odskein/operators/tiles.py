"""Origin by destination matrices with more places than a table can have columns.

Places get numbers in code order, and the matrix is cut into squares of ``side`` by ``side`` places.
A tile is one row: its place in the grid and the cells that are not empty, as a sorted list. A tile
has at most ``side * side`` cells however busy its places are, and an empty tile has no row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.operators.ids import with_ordered_id

SIDE = 512


class TiledMatrix(NamedTuple):
    """``places(id, code)`` and ``tiles(tile_row, tile_column, cells)``; a cell is (row, column, value).

    ``row`` and ``column`` count from 0 within the tile.
    """

    places: DataFrame
    tiles: DataFrame
    side: int


def od_tiles(
    flows: DataFrame,
    origin: str = "origin_iso",
    destination: str = "destination_iso",
    measure: str = "flights",
    side: int = SIDE,
) -> TiledMatrix:
    """The matrix of all flows, repeated pairs added up. A missing end is a place of its own, the last."""
    cells = flows.groupBy(F.col(origin).alias("_from"), F.col(destination).alias("_to")).agg(F.sum(measure).alias("value"))
    codes = cells.select(F.explode(F.array("_from", "_to")).alias("code")).distinct()
    places = with_ordered_id(codes, "code", start=0)
    ends = {}
    for end in ("_from", "_to"):
        ends[end] = places.select(F.col("id").alias(f"{end}_id"), F.col("code").alias(f"{end}_code"))
    numbered = cells
    for end, known in ends.items():
        numbered = numbered.join(known, F.col(end).eqNullSafe(F.col(f"{end}_code")))
    where = {name: F.floor(F.col(f"{end}_id") / side).cast("int") for name, end in (("tile_row", "_from"), ("tile_column", "_to"))}
    inside = [(F.col(f"{end}_id") % side).cast("int").alias(name) for name, end in (("row", "_from"), ("column", "_to"))]
    tiles = (
        numbered.select(*[c.alias(n) for n, c in where.items()], F.struct(*inside, "value").alias("cell"))
        .groupBy("tile_row", "tile_column")
        .agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    )
    return TiledMatrix(places, tiles, side)


def od_cells(
    matrix: TiledMatrix, origin: str = "origin_iso", destination: str = "destination_iso", measure: str = "flights"
) -> DataFrame:
    """The long form again: one row for each pair with flows."""
    cells = matrix.tiles.select("tile_row", "tile_column", F.inline("cells")).select(
        (F.col("tile_row").cast("bigint") * matrix.side + F.col("row")).alias("_from"),
        (F.col("tile_column").cast("bigint") * matrix.side + F.col("column")).alias("_to"),
        F.col("value").alias(measure),
    )
    return (
        cells.join(matrix.places.toDF("_from", origin), "_from")
        .join(matrix.places.toDF("_to", destination), "_to")
        .select(origin, destination, measure)
    )


def tile_totals(matrix: TiledMatrix) -> DataFrame:
    """Of each place the flows that leave it and that reach it, from the tiles: code, leaving, arriving."""
    cell = F.inline("cells")
    cells = matrix.tiles.select("tile_row", "tile_column", cell)
    ends = F.array(
        F.struct((F.col("tile_row").cast("bigint") * matrix.side + F.col("row")).alias("id"), F.col("value").alias("leaving"), F.lit(0).cast("bigint").alias("arriving")),
        F.struct((F.col("tile_column").cast("bigint") * matrix.side + F.col("column")).alias("id"), F.lit(0).cast("bigint").alias("leaving"), F.col("value").alias("arriving")),
    )
    totals = cells.select(F.inline(ends)).groupBy("id").agg(F.sum("leaving").alias("leaving"), F.sum("arriving").alias("arriving"))
    return totals.join(matrix.places, "id").select("code", "leaving", "arriving")
