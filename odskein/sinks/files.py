"""Flow tables as files.

Each output is a folder that the tasks write in parallel. Sorted outputs are range-partitioned on
all their sort columns, so one busy day is spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odskein.schemas import PROPERTIES
from odskein.sources.delimited import CSV_FORM
from odskein.sources.literals import inline_rows

# Texts the map shows, in its property table.
MAP_TEXTS = {
    "colors.scheme": "Default",
    "colors.darkMode": "no",
    "animate.flows": "no",
    "clustering": "yes",
    "flows.sheets": "flows",
    "msg.locationTooltip.incoming": "Incoming flights",
    "msg.locationTooltip.outgoing": "Outgoing flights",
    "msg.locationTooltip.internal": "Internal flights",
    "msg.flowTooltip.numOfTrips": "Number of flights",
    "msg.totalCount.allTrips": "{0} flights",
    "msg.totalCount.countOfTrips": "{0} of {1} flights",
}
# Properties the publisher of a map fills in.
PUBLISHER_PROPERTIES = [
    "title",
    "description",
    "source.name",
    "source.url",
    "createdBy.name",
    "createdBy.email",
    "createdBy.url",
    "mapbox.accessToken",
    "mapbox.mapStyle",
    "map.bbox",
]


def write_csv(df: DataFrame, path: str, gzip: bool = False) -> None:
    """CSV with a header; a missing value is an empty field, commas and quotes in a value are quoted."""
    writer = df.write.mode("overwrite").option("header", True).options(**CSV_FORM)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> DataFrame:
    """Parquet, optionally one subfolder per value of ``by``; returns the table read back."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_locations(places: DataFrame, path: str) -> None:
    """Locations without the code that only served to join them."""
    write_csv(places.drop("iso_a2"), path)


def write_timeline(timeline: DataFrame, path: str) -> None:
    """All days in one sorted table."""
    write_csv(timeline.orderBy("time", "origin", "dest", "count"), path)


def write_days(timeline: DataFrame, path: str) -> None:
    """One subfolder per day. Ranges over day and places keep a day's files few and bounded."""
    keys = ["time", "origin", "dest"]
    (
        timeline.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .partitionBy("time")
        .option("header", True)
        .options(**CSV_FORM)
        .csv(path)
    )


def map_properties(spark: SparkSession, **publisher: str | None) -> DataFrame:
    """The property table of a map: publisher's entries (dots as ``__``) before the fixed texts.

    The access token is the caller's to give; without one it stays NULL.
    """
    given = {name.replace("__", "."): value for name, value in publisher.items()}
    values = {**dict.fromkeys(PUBLISHER_PROPERTIES), **MAP_TEXTS, **given}
    return inline_rows(spark, PROPERTIES, list(values.items()))
