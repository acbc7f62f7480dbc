"""Delimited text whose bad rows are set aside instead of failing the read.

Every line of every file is a header, a good row or a rejected one. A rejected line keeps its text,
file and line number, and the reason: the first field, from left to right, that does not hold what its
column holds, or what is wrong with the line as a whole.

A line number needs the lines before it in the file. They are counted per piece of a file that one
task reads (one row per piece), so no task sees a file's lines together, however long it is.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odskein.sources.delimited import CSV_FORM

_BROKEN = "_broken"
_WHOLE = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


class CheckedRows(NamedTuple):
    """``rows`` with the declared columns; ``rejected`` with file, line, reason and text."""

    rows: DataFrame
    rejected: DataFrame


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = ()
) -> CheckedRows:
    """Read CSV files with a header line, keeping bad rows apart.

    Whole-number columns take ``4e3`` as 4000. An empty field is missing; it is rejected in a
    ``required`` column only. A line equal to the header is a header. An empty line, a line with too
    many or too few fields and a quote that its line does not close are rejected. Gzip files are read
    by one task each.
    """
    lines = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    parsed = lines.withColumn(
        "_row",
        F.from_csv("value", F.lit(_ddl(texts)), {**CSV_FORM, "columnNameOfCorruptRecord": _BROKEN}),
    ).withColumn("reason", _reason(schema, required))
    header = F.array(*[F.col("_row")[n] for n in schema.names]) == F.array(*[F.lit(n) for n in schema.names])
    body = parsed.where(~F.coalesce(header, F.lit(False)))
    rows = body.where(F.col("reason").isNull()).select(
        *[_value(F.col("_row")[f.name], f.dataType).alias(f.name) for f in schema]
    )
    rejected = body.where(F.col("reason").isNotNull())
    return CheckedRows(rows, _numbered(rejected, lines))


def _ddl(texts: T.StructType) -> str:
    columns = [f"`{name}` string" for name in (*texts.names, _BROKEN)]
    return ", ".join(columns)


def _reason(schema: T.StructType, required: tuple[str, ...]) -> Column:
    line, row = F.col("value"), F.col("_row")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    tests = [
        (F.trim(line) == "", F.lit("empty line")),
        (quotes % 2 == 1, F.lit("a quote is not closed")),
        (row[_BROKEN].isNotNull(), F.lit(f"not {len(schema)} fields")),
    ]
    for field in schema:
        text = row[field.name]
        if field.name in required:
            tests.append((text.isNull(), F.lit(f"{field.name} is missing")))
        bad = text.isNotNull() & _value(text, field.dataType).isNull()
        tests.append((bad, F.concat(F.lit(f"{field.name} holds no {_kind(field.dataType)}: "), text)))
    return F.coalesce(*[F.when(test, reason) for test, reason in tests])


def _kind(kind: T.DataType) -> str:
    name = kind.simpleString()
    return f"whole number of {_WHOLE[name]} bits" if name in _WHOLE else name


def _value(text: Column, kind: T.DataType) -> Column:
    """The field as its column's type; NULL where it is none."""
    name = kind.simpleString()
    if name == "string":
        return text
    if name in _WHOLE:
        exact = F.trim(text).try_cast("decimal(38, 9)")
        limit = 2 ** (_WHOLE[name] - 1)
        whole = (exact == F.floor(exact)) & exact.between(-limit, limit - 1)
        return F.when(whole, exact.try_cast(kind))
    return F.trim(text).try_cast(kind)


def _numbered(rejected: DataFrame, lines: DataFrame) -> DataFrame:
    """file, line, reason and text of the rejected lines."""
    pieces = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("file", "_block", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"))
    return rejected.join(pieces, ["file", "_block"]).select(
        "file",
        (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"),
        "reason",
        F.col("value").alias("text"),
    )
