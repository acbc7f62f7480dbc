"""Small DataFrame expressions shared by the operators that run without Python workers."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that separates words: space and the control characters 9 to 13.
SPACES = r"[ \t\n\x0B\f\r]+"
# What stands between words of letters and digits, once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    A bound variable of a higher-order function is the only name an expression can give to a
    value; written out, the value would be computed anew at each use, inside lambdas for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def spaced_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def plain_words(text: Column) -> Column:
    """Words of letters and digits of a text whose A-Z are lower-cased already."""
    return F.array_remove(F.split(text, BETWEEN), "")
