"""Labels for pairs of places, and text shaping."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from odskein.functions.nulls import if_known, join_text, paste_text


def directed_pair(origin: Column, destination: Column) -> Column:
    """``A>B``; a missing end leaves its side of the arrow empty."""
    return join_text(origin, F.lit(">"), destination)


def undirected_pair(a: Column, b: Column) -> Column:
    """``A<->B`` with the smaller code first; both sides are empty if either end is missing.

    Spark's ``least``/``greatest`` skip NULLs, which would print the known code twice.
    """
    return F.when(a.isNull() | b.isNull(), F.lit("<->")).otherwise(
        F.concat(F.least(a, b), F.lit("<->"), F.greatest(a, b))
    )


def collated(text: Column, collation: str | None) -> Column:
    """The text under a collation for comparing and sorting; byte order without one.

    ``UNICODE`` orders names as a reader expects: accented letters stand beside their plain ones and
    capitals do not come first. ``UNICODE_CI_AI`` and the like also make them equal.
    """
    return text if collation is None else F.collate(text, collation)


def sorted_label(a: Column, b: Column, collation: str | None = None) -> Column:
    """``A-B`` in ascending order of the two names, NULL when they cannot be compared.

    Names that a collation holds equal are told apart by their bytes, so both directions of a pair
    have the same label.
    """
    first = collated(a, collation) < collated(b, collation)
    if collation is not None:
        first = first | ((collated(a, collation) == collated(b, collation)) & (a < b))
    return if_known(first, paste_text(a, F.lit("-"), b), paste_text(b, F.lit("-"), a))


def in_order(column: str, collation: str | None = None) -> list[Column]:
    """Ascending order of a text column, missing values last; bytes settle what a collation ties."""
    order = [F.asc_nulls_last(column)]
    return order if collation is None else [collated(F.col(column), collation).asc_nulls_last(), *order]


def title_case(text: Column) -> Column:
    """Capitalise after every character that is neither a letter nor an apostrophe.

    ``initcap`` alone only starts a word after white space: ``Guinea-bissau``, ``Congo (drc)``.
    """
    words = F.split(F.lower(text), r"(?<=[^\p{L}\x27])")
    return F.array_join(F.transform(words, F.initcap), "")


def snake_name(name: str) -> str:
    """``ENTRY_DAY``, ``Entry Day`` and ``entryDay`` all become ``entry_day``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    return re.sub(r"[^0-9A-Za-z]+", "_", spaced).strip("_").lower()


def snake_columns(df):
    """Rename every column to snake case; two names that collide get a numeric suffix."""
    seen: dict[str, int] = {}
    names = []
    for name in map(snake_name, df.columns):
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)
