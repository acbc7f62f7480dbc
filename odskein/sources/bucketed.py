"""Tables stored in buckets of a key, so that joins and groupings on it need no shuffle."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class BucketedStar(NamedTuple):
    """A fact bucketed by its departure key and the airports bucketed by theirs, as catalog tables."""

    flights: DataFrame
    airports: DataFrame


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store a frame as a catalog table in ``buckets`` files by a hash of ``key``; returns it read back.

    The rows are dealt to one task for each bucket first, so a bucket is one file. Tables that are to
    meet without a shuffle need the same number of buckets and keys of the same type.
    """
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def write_star(
    spark: SparkSession, civil: DataFrame, airports: DataFrame, name: str, folder: str, buckets: int
) -> BucketedStar:
    """Store flights (as ``civil_flights`` gives them) by departure and the airports by key.

    ``name`` begins the names of both tables. Counting by departure and looking up its airport then
    read each bucket where it lies. A departure with very many flights is one bucket's; such a
    fact is better left to the shuffled join, which AQE can split.
    """
    return BucketedStar(
        write_bucketed(civil, f"{name}_flights", f"{folder}/flights", "sk_adep_id", buckets),
        write_bucketed(airports, f"{name}_airports", f"{folder}/airports", "sk_ap_id", buckets),
    )
