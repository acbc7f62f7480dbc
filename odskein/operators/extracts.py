"""Flow counts extracted from a flight fact and an airport dimension.

Shape of every plan: prune and filter the fact at the scan, count at the grain of the fact's own
keys, and only then look up the dimensions. After the count a busy airport is a handful of rows,
so the lookups see no hot key, however the flights are spread over the airports.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odskein.functions.labels import directed_pair, in_order, undirected_pair
from odskein.functions.nulls import blank_to_null
from odskein.functions.period import Period
from odskein.operators.versions import current_airports
from odskein.session import in_utc

# Fixed values of the source database.
UNKNOWN_COUNTRY = "##"
MILITARY = "M"
HELICOPTER = "H"
FLOWN_STATES = ("TE", "TA", "AA")


def civil_flights(
    flights: DataFrame,
    aircraft_types: DataFrame,
    period: Period,
    excluded_flight_type: str = MILITARY,
    excluded_aircraft: str = HELICOPTER,
) -> DataFrame:
    """Flights off block inside the period, without one flight type and one kind of aircraft.

    A missing (or blank) flight type, an unknown aircraft type and a type without a description all drop
    the flight. A type listed twice counts its flights twice, as an inner join does.
    """
    kept_types = aircraft_types.where(
        F.substring(blank_to_null(F.col("icao_desc")), 1, 1) != excluded_aircraft
    ).select(F.col("icao_type_code").alias("aircraft_type_icao_id"))
    return (
        flights.where(period.holds(flights, "lobt"))
        .where(_other_than("icao_flt_type", excluded_flight_type))
        .select("flt_uid", "lobt", "sk_adep_id", "sk_ades_id", "aircraft_type_icao_id")
        .join(kept_types, "aircraft_type_icao_id")
        .drop("aircraft_type_icao_id")
    )


@in_utc
def country_flows(
    flights: DataFrame,
    airports: DataFrame,
    aircraft_types: DataFrame,
    wef,
    til,
    *,
    split_key: bool = False,
    drop_unknown: bool = True,
    **exclusions: str,
) -> DataFrame:
    """Yearly number of flights between countries.

    ``split_key`` also groups on the departure airport's second country code without showing it,
    so a year and country pair can occur on several rows.
    """
    civil = civil_flights(flights, aircraft_types, Period.of(wef, til), **exclusions)
    return count_countries(civil, airports, split_key=split_key, drop_unknown=drop_unknown)


@in_utc
def count_countries(
    civil: DataFrame, airports: DataFrame, *, split_key: bool = False, drop_unknown: bool = True
) -> DataFrame:
    """``country_flows`` of flights that ``civil_flights`` chose, stored or not."""
    counted = civil.groupBy(F.year("lobt").alias("year"), "sk_adep_id", "sk_ades_id").agg(
        F.count("flt_uid").alias("n")
    )
    known = airports
    if drop_unknown:
        known = known.where(_other_than("ec_iso_ct_code", UNKNOWN_COUNTRY))
    departure = known.select(
        F.col("sk_ap_id").alias("sk_adep_id"),
        blank_to_null(F.col("ec_iso_ct_code")).alias("dep_iso_country_code"),
        blank_to_null(F.col("iso_ct_code")).alias("hidden_code"),
    )
    arrival = known.select(
        F.col("sk_ap_id").alias("sk_ades_id"),
        blank_to_null(F.col("ec_iso_ct_code")).alias("des_iso_country_code"),
    )
    keys = ["year", "dep_iso_country_code", "des_iso_country_code"]
    return (
        counted.join(departure, "sk_adep_id")
        .join(arrival, "sk_ades_id")
        .groupBy(*keys, *(["hidden_code"] if split_key else []))
        .agg(F.sum("n").alias("nb_of_flight"))
        .select(_text("year"), "nb_of_flight", "dep_iso_country_code", "des_iso_country_code")
    )


@in_utc
def airport_flows(
    flights: DataFrame,
    airports: DataFrame,
    aircraft_types: DataFrame,
    wef,
    til,
    *,
    grain: str = "instant",
    drop_unknown: bool = False,
    ordered: bool = True,
    **exclusions: str,
) -> DataFrame:
    """Number of flights between airports, per off-block instant or per year.

    At ``instant`` grain the instant itself is not shown, only its year. ``ordered`` sorts by
    falling count; leave it off when the result feeds another operator.
    """
    period = Period.of(wef, til)
    civil = civil_flights(flights, aircraft_types, period, **exclusions)
    if grain == "year":
        # The year takes the instant's place as the time key: far fewer groups, counted before
        # the dimension is looked up. Instants are nearly as many as the flights themselves, so
        # that count would only add a shuffle and is left to the final grouping.
        facts = (
            civil.groupBy(F.year("lobt").alias("time_key"), "sk_adep_id", "sk_ades_id")
            .agg(F.count("flt_uid").alias("n"))
        )
        year = _text("time_key")
        total = F.sum("n")
    elif grain == "instant":
        facts = civil.withColumnRenamed("lobt", "time_key")
        year = F.year("time_key").cast("string")
        total = F.count("flt_uid")
    else:
        raise ValueError(f"grain is 'instant' or 'year', not {grain!r}")
    known = airports
    if drop_unknown:
        known = known.where(_other_than("ec_iso_ct_code", UNKNOWN_COUNTRY))
    departure = known.select(
        F.col("sk_ap_id").alias("sk_adep_id"),
        blank_to_null(F.col("icao_ap_code")).alias("adep"),
        blank_to_null(F.col("ec_iso_ct_code")).alias("dep_iso_country_code"),
    )
    arrival = known.select(
        F.col("sk_ap_id").alias("sk_ades_id"),
        blank_to_null(F.col("icao_ap_code")).alias("ades"),
        blank_to_null(F.col("ec_iso_ct_code")).alias("des_iso_country_code"),
    )
    places = ["adep", "dep_iso_country_code", "ades", "des_iso_country_code"]
    flows = (
        facts.join(departure, "sk_adep_id")
        .join(arrival, "sk_ades_id")
        .groupBy("time_key", *places)
        .agg(total.alias("nb_of_flight"))
    )
    if ordered:
        # The time key settles ties: without it all single flights of a busy pair would be equal
        # to the sort, and land in one task.
        flows = flows.orderBy(F.desc("nb_of_flight"), "time_key", "adep", "ades")
    return flows.select(year.alias("year"), "nb_of_flight", *places)


def airports_valid(
    airports: DataFrame,
    wef,
    til,
    codes: list[str] | None = None,
    ordered: bool = True,
    collation: str | None = None,
) -> DataFrame:
    """Airport versions in force from before the period until after its (excluded) end.

    Sorted by code, in byte order or that of a collation.
    """
    period = Period.of(wef, til)
    rows = airports.where(period.spans(airports, "valid_from", "valid_to"))
    if codes is not None:
        rows = rows.where(F.col("icao_ap_code").isin(list(codes)))
    rows = rows.select(
        F.col("icao_ap_code").alias("icao"),
        F.col("icao_ap_name").alias("name"),
        F.col("iata_ap_code").alias("iata_code"),
        F.col("iata_ap_name").alias("iata_name"),
        "longitude",
        "latitude",
        F.col("iso_ct_code").alias("iso_code"),
        "iso_ct_name",
        "valid_from",
        "valid_to",
    )
    by_code = [*in_order("icao", collation), "valid_from", "valid_to"]
    return rows.orderBy(*by_code) if ordered else rows


@in_utc
def daily_airport_flows(
    flights: DataFrame,
    airports: DataFrame,
    wef,
    til,
    *,
    states: tuple[str, ...] = FLOWN_STATES,
    prefix_repair: bool = False,
) -> DataFrame:
    """Daily number of flights per airport pair, with name, country and position of both ends.

    The day is that of the airspace entry. The off-block bounds, a day wider at the start, only
    spare the scan: a flight enters the airspace at most a day after it leaves the block.
    """
    period = Period.of(wef, til)
    daily = (
        flights.where(period.holds(flights, "flt_lobt", look_back=timedelta(days=1)))
        .where(period.holds(flights, "flt_a_asp_prof_time_entry"))
        .where(F.col("flt_state").isin(list(states)))
        .groupBy(
            F.to_date("flt_a_asp_prof_time_entry").alias("entry_day"),
            blank_to_null(F.col("flt_dep_ad")).alias("adep"),
            blank_to_null(F.col("flt_ctfm_ades")).alias("ades"),
        )
        .agg(F.count("flt_uid").alias("flight"))
    )
    current = current_airports(airports, prefix_repair=prefix_repair)
    adep, ades = F.col("adep"), F.col("ades")
    return (
        daily.join(_airport_end(current, "adep"), "adep", "left")
        .join(_airport_end(current, "ades"), "ades", "left")
        .select(
            "entry_day",
            "adep",
            "ades",
            directed_pair(adep, ades).alias("adep_ades_pair_code"),
            undirected_pair(adep, ades).alias("airport_pair_code"),
            "flight",
            "adep_name",
            "ades_name",
            "adep_country_iso_name",
            "adep_country_iso_code",
            "ades_country_iso_name",
            "ades_country_iso_code",
            "adep_latitude",
            "adep_longitude",
            "ades_latitude",
            "ades_longitude",
        )
    )


def _airport_end(current: DataFrame, end: str) -> DataFrame:
    return current.select(
        F.col("cfmu_ap_code").alias(end),
        F.col("cfmu_ap_name").alias(f"{end}_name"),
        F.col("iso_ct_name").alias(f"{end}_country_iso_name"),
        F.col("iso_ct_code").alias(f"{end}_country_iso_code"),
        F.col("latitude").alias(f"{end}_latitude"),
        F.col("longitude").alias(f"{end}_longitude"),
    )


def _other_than(column: str, value: str) -> Column:
    """Neither missing, nor blank, nor ``value``; in a form that reaches the Parquet reader."""
    return (F.col(column) != value) & (F.col(column) != "")


def _text(year: str) -> Column:
    """Years are counted as numbers and shown as text, the type the source returns."""
    return F.col(year).cast("string").alias(year)
