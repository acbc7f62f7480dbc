"""Rows written in the program."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def inline_rows(spark: SparkSession, schema: StructType, rows: list[tuple]) -> DataFrame:
    """A small fixed table. It becomes a local relation, whose exact size the planner knows."""
    named = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(
        pa.Table.from_pylist(named, schema=to_arrow_schema(schema)), schema=schema
    )
