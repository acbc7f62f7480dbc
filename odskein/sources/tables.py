"""Tables in a catalog, in Parquet or ORC folders, or in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from odskein.functions.period import Period


# Statement that sets the session's clock, in the source database's dialect.
UTC_SESSION = "ALTER SESSION SET TIME_ZONE = 'UTC'"


def read_files(
    spark: SparkSession, path: str, schema: StructType | None = None, format: str = "parquet"
) -> DataFrame:
    """A columnar folder. Give the schema where it is known: it spares reading the footers."""
    reader = spark.read.format(format)
    return (reader.schema(schema) if schema else reader).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; a three-part name reaches a table in another catalog."""
    return spark.table(name)


def jdbc_options(
    url: str,
    table: str,
    column: str,
    bounds: Period | tuple[int, int],
    partitions: int,
    session_statement: str | None = UTC_SESSION,
    **options: str,
) -> dict[str, str]:
    """Options of a database read that splits a column's range into parallel queries.

    ``column`` is the time the flights are stored by, with a period as its bounds, or a number
    such as the flight's key. All splits are equally wide, so where one day may hold much of the
    table take the key. The bounds only place the splits and drop no rows: the extract still
    filters on the period, and Spark passes that filter to the database. Bounds and times are in
    UTC, so every connection sets its clock to that before it reads (None: it does not).
    """
    if isinstance(bounds, Period):
        bounds = (bounds.wef.isoformat(sep=" "), bounds.til.isoformat(sep=" "))
    lower, upper = map(str, bounds)
    if session_statement:
        options = {"sessionInitStatement": session_statement, **options}
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        **options,
    }


def read_database(spark: SparkSession, **options: str) -> DataFrame:
    """A table read over JDBC, with options as ``jdbc_options`` gives them."""
    return spark.read.format("jdbc").options(**options).load()


def bound_query(
    spark: SparkSession, text: str, period: Period | None = None, args=None, **tables: DataFrame
) -> DataFrame:
    """Run SQL with bound parameters over the given frames.

    Tables are written ``{name}`` in the text. Parameters are written ``:name`` and bound as
    literals, never pasted into the text; ``:wef`` and ``:til`` come from the period, as
    ``YYYY-MM-DDTHH:MM:SSZ``.
    """
    bound = {**(period.stamps() if period else {}), **(args or {})}
    return spark.sql(text, args=bound, **tables)
