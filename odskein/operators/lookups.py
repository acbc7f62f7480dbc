"""Joining an aggregate back to the rows it was made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = "_spread"


def with_totals(rows: DataFrame, totals: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``totals``, an aggregate on the same keys, so that hot keys can be split.

    An aggregate already lies partitioned by its keys, so a plain join shuffles the rows only. AQE
    splits a hot partition only between two shuffles of the join's own, and so would leave all
    rows of a hot key in one task. A hash of the keys as one more key makes the join shuffle both
    sides; the totals are one row per key by then. Where the totals are small they are broadcast as
    before.
    """
    spread = F.xxhash64(*keys).alias(SPREAD)
    return rows.select("*", spread).join(totals.select("*", spread), [*keys, SPREAD], how).drop(SPREAD)
