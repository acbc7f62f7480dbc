"""The half-open period ``[wef, til)`` that bounds every extract."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_instant(value: str | date | datetime) -> datetime:
    """Read ``2001``, ``2001-06``, ``2001-06-30`` or an ISO date-time as a UTC instant."""
    if isinstance(value, datetime):
        moment = value
    elif isinstance(value, date):
        moment = datetime(value.year, value.month, value.day)
    else:
        text = value.strip()
        if re.fullmatch(r"\d{4}", text):
            text += "-01-01"
        elif re.fullmatch(r"\d{4}-\d{2}", text):
            text += "-01"
        try:
            moment = datetime.fromisoformat(text)
        except ValueError:
            raise ValueError(f"not an ISO 8601 date or time: {value!r}") from None
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


@dataclass(frozen=True)
class Period:
    """``wef`` is inside the period, ``til`` is the first instant after it; None leaves a side open."""

    wef: datetime | None
    til: datetime | None

    @classmethod
    def of(cls, wef, til) -> "Period":
        period = cls(*(None if bound is None else parse_instant(bound) for bound in (wef, til)))
        if None not in (period.wef, period.til) and period.wef >= period.til:
            raise ValueError(f"the period ends before it begins: {wef!r}, {til!r}")
        return period

    def holds(self, df: DataFrame, column: str, look_back: timedelta = timedelta(0)) -> Column:
        """``wef - look_back <= column < til``; an open side sets no bound.

        The bounds are literals of the column's own type, so the comparison needs no cast on the
        column and reaches the Parquet reader as a pushed filter.
        """
        kind = df.schema[column].dataType
        test = F.lit(True)
        if self.wef is not None:
            test = test & (F.col(column) >= instant_literal(self.wef - look_back, kind, next_day=True))
        if self.til is not None:
            test = test & (F.col(column) < instant_literal(self.til, kind, next_day=True))
        return test

    def spans(self, df: DataFrame, starts: str, ends: str) -> Column:
        """``starts <= wef`` and ``ends > til``: a validity interval around the whole period."""
        self._closed()
        start = instant_literal(self.wef, df.schema[starts].dataType)
        end = instant_literal(self.til, df.schema[ends].dataType)
        return (F.col(starts) <= start) & (F.col(ends) > end)

    def years(self) -> list[int]:
        """The calendar years the period touches; known without reading any data."""
        self._closed()
        last = self.til - timedelta(microseconds=1)
        return list(range(self.wef.year, last.year + 1))

    def stamps(self) -> dict[str, str]:
        """The bounds as ``YYYY-MM-DDTHH:MM:SSZ``, for binding to SQL text."""
        self._closed()
        form = "%Y-%m-%dT%H:%M:%SZ"
        return {"wef": self.wef.strftime(form), "til": self.til.strftime(form)}

    def _closed(self) -> None:
        if self.wef is None or self.til is None:
            raise ValueError("this needs a period with both bounds")


def instant_literal(moment: datetime, kind: T.DataType, next_day: bool = False) -> Column:
    """``moment`` (UTC) as a literal of the given date or timestamp type.

    A date column holds midnights. A moment within a day becomes that day's date, or with
    ``next_day`` the one after, whichever compares with midnights as the moment does.
    """
    if isinstance(kind, T.DateType):
        late = next_day and moment.time() != time(0)
        return F.lit(moment.date() + timedelta(days=1 if late else 0))
    text = moment.isoformat(sep=" ")
    if isinstance(kind, T.TimestampType):
        text += "Z"
    elif not isinstance(kind, T.TimestampNTZType):
        raise TypeError(f"a period needs a date or timestamp column, not {kind.simpleString()}")
    return F.lit(text).cast(kind)
