"""Country pairs per day, their places on the map, and the timeline between the places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odskein.functions.labels import title_case
from odskein.functions.nulls import if_known, paste_text
from odskein.operators.checks import unique_lookup
from odskein.operators.ids import with_ordered_id
from odskein.schemas import CENTROIDS, OVERRIDES
from odskein.session import in_utc
from odskein.sources.literals import inline_rows

# An airport whose country the source gets wrong.
MISPLACED_AIRPORT, ITS_COUNTRY = "KVPC", "US"

# Places the centroid table lacks. name, iso_a3, iso_a2, longitude, latitude.
EXTRA_CENTROIDS = [
    ("French Antilles", None, "XF", -61.2939723, 14.6345865),
    ("Mayotte", None, "YT", 45.138333, -12.843056),
    ("Netherland Antilles", None, "AN", -61.153894, 14.6339221),
    ("UNKNOWN", None, "##", 0.0, 0.0),
]

# Places drawn elsewhere than at their centroid, or named otherwise.
# iso_a2, name, latitude, longitude; None keeps what the centroid table says.
LOCATION_OVERRIDES = [
    ("CS", "Serbia and Montenegro", 44.2215031993, 20.7895833363),
    ("ES-CN", None, 28.4398708, -16.9743268),
    ("FR", None, 47.5, 3.2),
    ("GF", "French Guiana", 4.100192, -53.165735),
    ("GI", "Gibraltar", 36.131667, -5.351667),
    ("NO", None, 60.980820, 8.855597),
    ("RE", "Réunion", -21.114444, 55.5325),
    ("RU", None, 56.292129, 43.6460081),
    ("SI", None, 46.1155477207, 14.8044423776),
    ("SJ", "Svalbard and Jan Mayen", 75.5300298, 3.2220993),
    ("US", None, 35.843965, -78.7851414),
]


def repair_country(
    daily: DataFrame, airport: str = MISPLACED_AIRPORT, country: str = ITS_COUNTRY
) -> DataFrame:
    """Set the country code of one airport, at either end."""
    fixed = {}
    for end in ("adep", "ades"):
        code = f"{end}_country_iso_code"
        fixed[code] = if_known(F.col(end) == airport, country, F.col(code))
    return daily.withColumns(fixed)


def country_pairs(daily: DataFrame) -> DataFrame:
    """Flights per day and ordered pair of country codes.

    A missing code is a group of its own, apart from the code ``NA`` though both read ``NA`` in
    the pair's label. Where a code comes with several names the first in the alphabet is shown.

    The flights are added up with the names among the keys, which Spark does by hashing; the
    choice of a name, which needs a sort, is left to the few rows that remain.
    """
    source, target = F.col("source_iso2c"), F.col("target_iso2c")
    pair = ["entry_day", "source_iso2c", "target_iso2c"]
    return (
        daily.groupBy(
            "entry_day",
            F.col("adep_country_iso_code").alias("source_iso2c"),
            F.col("ades_country_iso_code").alias("target_iso2c"),
            F.col("adep_country_iso_name").alias("source"),
            F.col("ades_country_iso_name").alias("target"),
        )
        .agg(F.sum("flight").alias("count"))
        .groupBy(*pair)
        .agg(
            F.sum("count").alias("count"),
            F.min("source").alias("source"),
            F.min("target").alias("target"),
        )
        .select(
            "entry_day",
            paste_text(source, F.lit(">"), target).alias("airport_country_pair"),
            "count",
            title_case(F.col("source")).alias("source"),
            title_case(F.col("target")).alias("target"),
            "source_iso2c",
            "target_iso2c",
        )
    )


def all_centroids(centroids: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """The centroid table and the extra places, matched by column name.

    An extra place takes the place of a centroid with the same code.
    """
    if extra is None:
        extra = inline_rows(centroids.sparkSession, CENTROIDS, EXTRA_CENTROIDS)
    kept = centroids.join(extra.select("iso_a2"), "iso_a2", "left_anti")
    return kept.unionByName(extra, allowMissingColumns=True)


def locations(
    pairs: DataFrame,
    centroids: DataFrame,
    extra: DataFrame | None = None,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """Every country code that occurs in the pairs, with id, name and position.

    Ids count from 1 in code order. A code without a centroid keeps NULL name and position; a
    code with two centroids fails the query.
    """
    spark = pairs.sparkSession
    if overrides is None:
        overrides = default_overrides(spark)
    place = unique_lookup(
        all_centroids(centroids, extra), "iso_a2", ["name", "latitude", "longitude"]
    )
    override = unique_lookup(overrides, "iso_a2", ["name", "latitude", "longitude"]).toDF(
        "iso_a2", "own_name", "own_latitude", "own_longitude"
    )
    return (
        with_ordered_id(country_codes(pairs), "iso_a2")
        .join(place, "iso_a2", "left")
        .join(override, "iso_a2", "left")
        .select(
            "id",
            F.coalesce("own_name", "name").alias("name"),
            "iso_a2",
            F.coalesce("own_latitude", "latitude").alias("lat"),
            F.coalesce("own_longitude", "longitude").alias("lon"),
        )
    )


def country_codes(pairs: DataFrame) -> DataFrame:
    """The distinct country codes at either end of the pairs."""
    return (
        pairs.select("entry_day", "source_iso2c", "target_iso2c")
        .unpivot("entry_day", ["source_iso2c", "target_iso2c"], "col", "iso_a2")
        .select("iso_a2")
        .where(F.col("iso_a2").isNotNull())
        .distinct()
    )


@in_utc
def flow_timeline(
    pairs: DataFrame, places: DataFrame, threshold: int = 1, ordered: bool = True
) -> DataFrame:
    """Flights per day between location ids, from ``threshold`` flights up.

    Pairs with an end that has no location are left out.
    """
    ids = places.select("id", "iso_a2")
    rows = (
        pairs.where(F.col("count") >= threshold)
        .join(ids.toDF("origin", "source_iso2c"), "source_iso2c")
        .join(ids.toDF("dest", "target_iso2c"), "target_iso2c")
        .select("origin", "dest", "count", F.to_date("entry_day").cast("string").alias("time"))
    )
    return rows.orderBy("time", "origin", "dest", "count") if ordered else rows


def default_overrides(spark: SparkSession) -> DataFrame:
    """The overrides of the European map."""
    return inline_rows(spark, OVERRIDES, LOCATION_OVERRIDES)
