"""Session settings the operators rely on."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

# Times of day become days and years in UTC everywhere in this package.
TIME_ZONE = "UTC"
_CLOCK = RLock()

# Joins carry no broadcast hints: Catalyst broadcasts a side only when its estimated or measured
# size is under spark.sql.autoBroadcastJoinThreshold. Above it the join shuffles both sides, and
# AQE splits the partitions a hot key fills; operators.lookups sees to it where one side is an
# aggregate that lies partitioned by the key already.
DEFAULTS = {
    "spark.sql.session.timeZone": TIME_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package's defaults; ``conf`` entries (dots as ``__``) override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def in_utc(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build an operator's frame with the session clock at UTC, then set the clock back.

    Spark binds the time zone of an expression when it analyses the frame, so days and years
    stay in UTC when the frame runs. Threads that build such frames take turns, so each finds and
    leaves the clock as it was set.
    """

    @wraps(operator)
    def run(first: DataFrame, *args, **kwargs) -> DataFrame:
        conf = first.sparkSession.conf
        with _CLOCK:
            before = conf.get("spark.sql.session.timeZone")
            conf.set("spark.sql.session.timeZone", TIME_ZONE)
            try:
                return operator(first, *args, **kwargs)
            finally:
                conf.set("spark.sql.session.timeZone", before)

    return run
