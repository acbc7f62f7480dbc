"""Delimited text files, and the options that their reader and writer share.

In all of them only the empty field is missing: the text ``NA`` is the code of Namibia.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from odskein.functions.labels import snake_columns
from odskein.schemas import FLOW_TEXT_COLUMNS, RAW_FLOWS_CSV


# A quote inside a quoted value is doubled; blanks around a value belong to it; only the empty field
# is missing.
CSV_FORM = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, **options: str
) -> DataFrame:
    """A CSV file with a header; without a schema the types are inferred in an extra pass.

    Values with line breaks need ``multiLine="true"``, which makes a file unsplittable.

    A gzip file (known by its extension) is read by one task per file. Repartition the result
    before heavy work, or keep extracts as Parquet.
    """
    reader = spark.read.option("header", True).options(**{**CSV_FORM, **options})
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_raw_flows(spark: SparkSession, path: str) -> DataFrame:
    """The typed file of yearly country flows; a field that is no whole number fails the query."""
    text = StructType([StructField(f.name, StringType()) for f in RAW_FLOWS_CSV])
    rows = read_csv(spark, path, text)
    return rows.select(
        *[
            F.col(f.name) if isinstance(f.dataType, StringType) else whole_number(f.name).cast(f.dataType).alias(f.name)
            for f in RAW_FLOWS_CSV
        ]
    )


def read_whole_numbers(
    spark: SparkSession, path: str, text_columns: list[str] = FLOW_TEXT_COLUMNS
) -> DataFrame:
    """A file whose columns hold whole numbers except the named text columns.

    A field that is no whole number fails the query.
    """
    header = spark.read.option("header", True).options(**CSV_FORM).csv(path).columns
    schema = StructType([StructField(name, StringType()) for name in header])
    text = read_csv(spark, path, schema)
    return text.select(
        *[
            F.col(n) if n in text_columns else whole_number(n).alias(n)
            for n in header
        ]
    )


def whole_number(column: str) -> Column:
    """Text as a 64-bit number, which may be written ``4e3``; only the empty field is NULL."""
    text = F.trim(F.col(column))
    exact = text.try_cast("decimal(38, 9)")
    whole = (exact == F.floor(exact)) & exact.between(-(2**63), 2**63 - 1)
    wrong = F.raise_error(F.concat(F.lit(f"{column} holds no whole number: "), text))
    return F.when(text.isNull(), F.lit(None)).when(whole, exact.cast("bigint")).otherwise(wrong).cast("bigint")


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Country centroids, from whichever file columns snake-case to the names wanted."""
    rows = snake_columns(read_csv(spark, path))
    return rows.select(
        "name",
        "iso_a3",
        "iso_a2",
        F.col("longitude").cast("double").alias("longitude"),
        F.col("latitude").cast("double").alias("latitude"),
    )
