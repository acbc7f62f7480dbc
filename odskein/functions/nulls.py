"""Expressions whose treatment of NULL differs from Spark's nearest built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_known(test: Column, yes, no) -> Column:
    """Choose ``yes`` or ``no``, but NULL where the test itself is NULL.

    Spark's CASE sends a NULL test to ELSE, which would keep a value whose condition is unknown.
    """
    return F.when(test, _column(yes)).when(~test, _column(no))


def blank_to_null(column: Column) -> Column:
    """The empty string counts as a missing value in the source database."""
    return F.nullif(column, F.lit(""))


def join_text(*parts) -> Column:
    """Concatenate, reading a missing part as the empty string."""
    return F.concat(*[F.coalesce(_column(p).cast("string"), F.lit("")) for p in parts])


def paste_text(*parts) -> Column:
    """Concatenate, spelling a missing part as the text ``NA``."""
    return F.concat(*[F.coalesce(_column(p).cast("string"), F.lit("NA")) for p in parts])


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
