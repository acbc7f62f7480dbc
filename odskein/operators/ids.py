"""Consecutive ids in the order of a text key, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Bytes of the key that are compared at a time, as hexadecimal digits.
CHUNK = 4
# Sorts after every chunk of digits: where a missing key stands.
LAST = "~"


def with_ordered_id(df: DataFrame, key: str, name: str = "id", start: int = 1) -> DataFrame:
    """Number the rows of ``df`` (one per ``key``) in ascending key order; a NULL key comes last.

    A key is read as a path of two-byte chunks. At each step, the keys that take a smaller chunk
    come before it; how many those are is a running sum over the chunks that follow the same
    prefix, at most 65,793 rows whatever the data. The sum over the steps is the key's place, so
    no window ever holds the rows of a prefix, however many keys share it. Byte order is Spark's
    string order.
    """
    code = F.hex(F.encode(F.col(key), "UTF-8"))
    steps = F.sequence(F.lit(0), F.ceil(F.length(code) / CHUNK).cast("int"))
    path = F.transform(
        steps,
        lambda i: F.struct(
            F.substr(code, F.lit(1), i * CHUNK).alias("prefix"),
            F.substr(code, i * CHUNK + 1, F.lit(CHUNK)).alias("chunk"),
        ),
    )
    missing = F.array(F.struct(F.lit("").alias("prefix"), F.lit(LAST).alias("chunk")))
    keys = df.select(F.col(key).alias("_key"), F.inline(F.coalesce(path, missing)))
    before = Window.partitionBy("prefix").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    smaller = (
        keys.groupBy("prefix", "chunk")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("prefix", "chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    places = (
        keys.join(smaller, ["prefix", "chunk"])
        .groupBy("_key")
        .agg((F.sum("_before") + start).alias("_place"))
    )
    if df.columns == [key]:  # nothing else to bring along
        return places.select(F.col("_place").alias(name), F.col("_key").alias(key))
    return df.join(places, F.col(key).eqNullSafe(F.col("_key"))).select(
        F.col("_place").alias(name), *df.columns
    )
