"""The daily extract kept up to date: only the days that new flights touch are counted again."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odskein.functions.period import Period
from odskein.operators.extracts import FLOWN_STATES, daily_airport_flows
from odskein.session import in_utc
from odskein.sinks.day_tables import days_in, read_days, replace_days

DAILY_FLOWS = (
    "entry_day date, adep string, ades string, adep_ades_pair_code string, airport_pair_code string, flight bigint, "
    "adep_name string, ades_name string, adep_country_iso_name string, adep_country_iso_code string, "
    "ades_country_iso_name string, ades_country_iso_code string, adep_latitude double, adep_longitude double, "
    "ades_latitude double, ades_longitude double"
)
ENTRY, OFF_BLOCK = "flt_a_asp_prof_time_entry", "flt_lobt"
# What is written and counted again as a whole: "day", or a wider unit where a day has few flights.
UNIT, PART = "day", "entry_part"


def next_unit(first: date, unit: str) -> date:
    """The day after a day, month or year that begins on ``first``."""
    if unit == "day":
        return first + timedelta(days=1)
    months = first.year * 12 + first.month - 1 + {"month": 1, "year": 12}[unit]
    return date(months // 12, months % 12 + 1, 1)


def stretches(firsts: list[date], unit: str = UNIT) -> list[tuple[date, date]]:
    """Days (or wider units, by their first days) as half-open stretches of consecutive ones."""
    found: list[tuple[date, date]] = []
    for first in sorted(set(firsts)):
        end = next_unit(first, unit)
        if found and found[-1][1] == first:
            found[-1] = (found[-1][0], end)
        else:
            found.append((first, end))
    return found


@in_utc
def flights_of_days(
    flights: DataFrame, days: list[date], look_back: timedelta | None = timedelta(days=1), unit: str = UNIT
) -> DataFrame:
    """Flights that enter in one of the units, and leave the block at most ``look_back`` before their day.

    None sets no bound on the off-block time. The bound holds for each flight's own day, so a day's
    flights do not depend on the days that are counted with it; the same bounds around the
    stretches of days are literals, which reach the scan.
    """

    def inside(column: str, back: timedelta) -> Column:
        periods = [Period(*(datetime(d.year, d.month, d.day) for d in stretch)) for stretch in stretches(days, unit)]
        return reduce(lambda a, b: a | b, [p.holds(flights, column, back) for p in periods], F.lit(False))

    kept = flights.where(inside(ENTRY, timedelta(0)))
    if look_back is None:
        return kept
    left, day = F.col(OFF_BLOCK), F.to_date(ENTRY)
    kind = flights.schema[OFF_BLOCK].dataType
    return kept.where(inside(OFF_BLOCK, look_back)).where(
        (left >= F.date_sub(day, look_back.days).cast(kind)) & (left < F.date_add(day, 1).cast(kind))
    )


def _part(day: Column, unit: str) -> Column:
    return F.date_trunc(unit, day.cast("timestamp_ntz")).cast("date")


@in_utc
def touched_days(new_flights: DataFrame, unit: str = UNIT) -> list[date]:
    """The days (or wider units) on which flights enter that came in, of whatever state: a state may have changed."""
    return days_in(new_flights.select(_part(F.to_date(ENTRY), unit).alias(PART)), PART)


def update_daily_flows(
    folder: str,
    flights: DataFrame,
    new_flights: DataFrame,
    airports: DataFrame,
    *,
    states: tuple[str, ...] = FLOWN_STATES,
    look_back: timedelta | None = timedelta(days=1),
    unit: str = UNIT,
) -> int | None:
    """Count the days that ``new_flights`` touch again and put them in place of what the table holds.

    ``flights`` are all flights known now, the new ones among them. Removed flights count as touched
    too: pass their rows with the new ones. A change of the airports changes every day; then pass all
    flights as new ones. ``unit`` is the table's for good. Returns the commit, or None if no day is
    touched. If the run breaks off before its commit, the table stays as it was and the same load can be
    run again.
    """
    days = touched_days(new_flights, unit)
    if not days:
        return None
    kept = flights_of_days(flights, days, look_back, unit)
    rows = daily_airport_flows(kept, airports, None, None, states=states)
    return replace_days(rows.withColumn(PART, _part(F.col("entry_day"), unit)), folder, days, PART)


def daily_flows(spark: SparkSession, folder: str, wef=None, til=None, unit: str = UNIT) -> DataFrame:
    """The days of a period from the table that ``update_daily_flows`` keeps."""
    period = Period.of(wef, til)
    rows = read_days(spark, folder, f"{DAILY_FLOWS}, {PART} date", day=PART)
    within = period.holds(rows, "entry_day")
    if period.wef is not None:  # units that begin before the period may reach into it
        first = {"day": period.wef, "month": period.wef.replace(day=1), "year": period.wef.replace(month=1, day=1)}[unit]
        within = within & (F.col(PART) >= F.lit(first.date()))
    if period.til is not None:
        within = within & Period(None, period.til).holds(rows, PART)
    return rows.where(within).drop(PART)
