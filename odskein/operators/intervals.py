"""Validity intervals of versions: where several are in force at once, and where none is.

A flight looked up by airport and time counts twice where two versions of the airport hold, and is
lost where none does. Both are found by a sweep over the intervals' ends: a start adds one, an end
takes one away, and the running sum is the number of versions in force.

An interval is half-open, ``[start, end)``. An end that is missing leaves it open; a missing start
does likewise. An interval that ends at its start or before it holds at no time and is reported by
``empty_versions``.

The ends are added up per key and instant before anything is sorted. A window over a key's instants
could still hold a third of all rows; so the running sum is taken in two steps, over a key's spans of
time first and over the instants within each span then, and a hot key is spread over its spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odskein.operators.lookups import with_totals
from odskein.session import in_utc

# Stand for "since ever" and "for ever" inside the sweep.
FIRST, LAST = "0001-01-01", "9999-12-31"


@in_utc
def versions_in_force(
    versions: DataFrame, keys: list[str], start: str, end: str, span: str = "MONTH"
) -> DataFrame:
    """Of each key the stretches of time with one number of versions: keys, since, until, n_versions.

    ``since`` is None where a version has no start, ``until`` where one has no end. ``span`` is the
    unit of time that one step of the sweep holds. Missing keys are a key like others.
    """
    kind = versions.schema[start].dataType
    rows = versions.where(F.coalesce(F.col(start) < F.col(end), F.lit(True)))
    bounds = F.array(
        F.struct(_known(F.col(start), FIRST, kind).alias("_at"), F.lit(1).alias("_step")),
        F.struct(_known(F.col(end), LAST, kind).alias("_at"), F.lit(-1).alias("_step")),
    )
    steps = (
        rows.select(F.struct(*keys).alias("_key"), F.inline(bounds))
        .groupBy("_key", "_at")
        .agg(F.sum("_step").alias("_step"))
        .where(F.col("_step") != 0)
        .withColumn("_span", F.date_trunc(span, F.col("_at")))
    )
    spans = steps.groupBy("_key", "_span").agg(F.sum("_step").alias("_sum"), F.min("_at").alias("_first"))
    by_span = Window.partitionBy("_key").orderBy("_span")
    before = F.sum("_sum").over(by_span.rowsBetween(Window.unboundedPreceding, -1))
    offsets = spans.select(
        "_key",
        "_span",
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.lead("_first").over(by_span).alias("_next"),
    )
    within = Window.partitionBy("_key", "_span").orderBy("_at")
    return (
        with_totals(steps, offsets, ["_key", "_span"])
        .select(
            "_key",
            "_at",
            F.coalesce(F.lead("_at").over(within), F.col("_next")).alias("_until"),
            (F.col("_before") + F.sum("_step").over(within)).alias("n_versions"),
        )
        .where(F.col("_until").isNotNull())
        .select(
            "_key.*",
            _shown(F.col("_at"), FIRST, kind).alias("since"),
            _shown(F.col("_until"), LAST, kind).alias("until"),
            "n_versions",
        )
    )


def version_faults(versions: DataFrame, keys: list[str], start: str, end: str, span: str = "MONTH") -> DataFrame:
    """Stretches of time in which a key has several versions or none: keys, since, until, n_versions.

    Before a key's first version and after its last one it has no hole.
    """
    return versions_in_force(versions, keys, start, end, span).where(F.col("n_versions") != 1)


def empty_versions(versions: DataFrame, start: str, end: str) -> DataFrame:
    """Versions that hold at no time, because they end where they start or before."""
    return versions.where(F.col(start) >= F.col(end))


def _known(at: Column, instead: str, kind: T.DataType) -> Column:
    return F.coalesce(at, F.lit(instead).cast(kind))


def _shown(at: Column, instead: str, kind: T.DataType) -> Column:
    return F.nullif(at, F.lit(instead).cast(kind))
