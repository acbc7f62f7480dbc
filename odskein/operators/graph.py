"""Nodes and links of a flow diagram."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.operators.ids import with_ordered_id
from odskein.operators.matrices import above_limit, yearly_limit


class FlowGraph(NamedTuple):
    """``nodes(id, name)`` and ``links(source, target, value)``, ids from 0 in name order."""

    nodes: DataFrame
    links: DataFrame


def od_graph(
    flows: DataFrame, year: int, fpd: int | float | Fraction | Decimal | str = 40
) -> FlowGraph:
    """One year's flows above ``fpd`` flights a day (exactly), as a graph of departures and arrivals.

    A country is two nodes, ``XXdep`` and ``XXdes``, so links only run from left to right.
    Nodes are those of the kept links; parallel links are added up before the comparison.
    """
    totals = (
        flows.where(F.col("year").cast("int") == int(year))
        .where(F.col("origin_iso").isNotNull() & F.col("destination_iso").isNotNull())
        .groupBy("origin_iso", "destination_iso")
        .agg(F.sum("flights").alias("value"))
    )
    kind = totals.schema["value"].dataType.simpleString()
    edges = totals.where(above_limit("value", kind, yearly_limit(fpd))).select(
        F.concat("origin_iso", F.lit("dep")).alias("from_name"),
        F.concat("destination_iso", F.lit("des")).alias("to_name"),
        "value",
    )
    names = edges.select(F.explode(F.array("from_name", "to_name")).alias("name")).distinct()
    nodes = with_ordered_id(names, "name", start=0)
    links = (
        edges.join(nodes.toDF("source", "from_name"), "from_name")
        .join(nodes.toDF("target", "to_name"), "to_name")
        .select("source", "target", "value")
    )
    return FlowGraph(nodes, links)
