"""Schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def schema_of(columns: str) -> T.StructType:
    """Columns as ``name type, name type``; unlike DDL parsing this needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


FLIGHTS = schema_of(
    "flt_uid string, lobt timestamp, sk_adep_id bigint, sk_ades_id bigint, "
    "aircraft_type_icao_id string, icao_flt_type string"
)

AIRPORTS = schema_of(
    "sk_ap_id bigint, icao_ap_code string, icao_ap_name string, iata_ap_code string, "
    "iata_ap_name string, ec_iso_ct_code string, iso_ct_code string, iso_ct_name string, "
    "longitude double, latitude double, valid_from timestamp, valid_to timestamp, "
    "cfmu_ap_code string, cfmu_ap_name string"
)

AIRCRAFT_TYPES = schema_of("icao_type_code string, icao_desc string")

OPERATIONAL_FLIGHTS = schema_of(
    "flt_uid string, flt_lobt timestamp, flt_a_asp_prof_time_entry timestamp, "
    "flt_dep_ad string, flt_ctfm_ades string, flt_state string"
)

COUNTRY_FLOWS = schema_of(
    "year string, nb_of_flight bigint, dep_iso_country_code string, des_iso_country_code string"
)

RAW_FLOWS_CSV = schema_of(
    "YEAR int, NB_OF_FLIGHT bigint, DEP_ISO_COUNTRY_CODE string, DES_ISO_COUNTRY_CODE string"
)

PREPARED_FLOWS = schema_of(
    "year int, flights bigint, origin_iso string, origin_name string, origin_region_name string, "
    "destination_iso string, destination_name string, destination_region_name string"
)

# Text columns of the prepared and pivoted flow files; every other column holds whole numbers.
FLOW_TEXT_COLUMNS = [
    "origin_iso",
    "origin_name",
    "origin_region_name",
    "destination_iso",
    "destination_name",
    "destination_region_name",
]

DAILY_AIRPORT_FLOWS = schema_of(
    "entry_day date, adep string, ades string, adep_ades_pair_code string, "
    "airport_pair_code string, flight bigint, adep_name string, ades_name string, "
    "adep_country_iso_name string, adep_country_iso_code string, ades_country_iso_name string, "
    "ades_country_iso_code string, adep_latitude double, adep_longitude double, "
    "ades_latitude double, ades_longitude double"
)

COUNTRY_PAIRS = schema_of(
    "entry_day date, airport_country_pair string, count bigint, source string, target string, "
    "source_iso2c string, target_iso2c string"
)

CLASSIFICATION = schema_of(
    "iso2c string, country_name string, un_region string, home_region string, sub_region string"
)

COUNTRIES = schema_of("iso string, name string, show int")
REGIONS = schema_of("name string")
YEARS = schema_of("year int")

CENTROIDS = schema_of(
    "name string, iso_a3 string, iso_a2 string, longitude double, latitude double"
)
OVERRIDES = schema_of("iso_a2 string, name string, latitude double, longitude double")
LOCATIONS = schema_of("id bigint, name string, iso_a2 string, lat double, lon double")
TIMELINE = schema_of("origin bigint, dest bigint, count bigint, time string")
PROPERTIES = schema_of("property string, value string")
