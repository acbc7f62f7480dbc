"""Views of the trade tables in the roles the operators expect.

A line item is a flight from its supplier's nation to its customer's nation. The order date is the
off-block time, the ship date the airspace entry, the return flag the flight type, the part the
aircraft type and the order status the flight state. Nations are airports and regions countries,
or, for the country-level operators, nations are countries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odskein.operators.checks import sorted_values
from odskein.operators.extracts import country_flows
from odskein.operators.recode import prepare_columns
from odskein.operators.regions import with_region
from odskein.schemas import schema_of
from odskein.sources.tables import read_files

# The exclusions in the trade tables' terms: returned goods, and one letter of the part type.
EXCLUSIONS = {"excluded_flight_type": "R", "excluded_aircraft": "E"}
STATES = ("F", "O")
HOME = "EUROPE"

# The periods of the queries that are about one, and no bounds for all others.
ALL_TIME = ("1995", "2002")
TWO_YEARS = ("1996-01-01", "1998-01-01")
OPEN = (None, None)

SOME_AIRPORTS = ["Customer#000000000", "Customer#000000004", "nowhere"]

# Nations that take part in a rule.
RETIRED_CODES = {"NATION_3": "NATION_4", "NATION_17": "NATION_18"}
LATE_REGIONS = {"NATION_7": "SOUTH", "NATION_8": "EAST", "NATION_9": "SOUTH"}
LATE_NAMES = {"NATION_7": "Antilles"}
WIDE_REGIONS = {"ASIA": "EAST", "MIDDLE EAST": "EAST"}


# The schemas are given, so that no query reads file footers before it starts.
_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_files(spark, f"{folder}/{name}.parquet", schema_of(_TABLES[name]))


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of files: a pattern, as the table may be one file and no folder."""
    return spark.readStream.schema(_TABLES["events"]).parquet(f"{folder}/events*.parquet")


def order_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a version of its customer that holds for 30 days, a pending one for ever."""
    orders = table(spark, folder, "orders")
    until = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
    return orders.select(
        F.col("o_custkey").alias("code"), F.col("o_orderdate").alias("valid_from"), until.alias("valid_to")
    )


def shipments(spark: SparkSession, folder: str, names: DataFrame | None = None) -> DataFrame:
    """Line items with the nation's key at both ends, and its name if ``names`` gives one per key.

    Everything a customer or supplier is known by is joined to the customers and suppliers, and
    the customers to the orders, before the much larger line items come in: those are shuffled
    once per key at most. The joins carry no hints: a side is broadcast only while it is small,
    otherwise both are shuffled and AQE splits the partitions of hot keys.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("to_nation")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("from_nation")
    )
    if names is not None:
        customers = customers.join(names.toDF("to_nation", "to_name"), "to_nation")
        suppliers = suppliers.join(names.toDF("from_nation", "from_name"), "from_nation")
    orders = (
        table(spark, folder, "orders")
        .select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderstatus"
        )
        .join(customers, "o_custkey")
    )
    return lines.join(orders, "l_orderkey").join(suppliers, "l_suppkey")


def flights(spark: SparkSession, folder: str) -> DataFrame:
    return shipments(spark, folder).select(
        F.col("l_orderkey").alias("flt_uid"),
        F.col("o_orderdate").alias("lobt"),
        F.col("from_nation").alias("sk_adep_id"),
        F.col("to_nation").alias("sk_ades_id"),
        F.col("l_partkey").alias("aircraft_type_icao_id"),
        F.col("l_returnflag").alias("icao_flt_type"),
    )


def aircraft_types(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("icao_type_code"), F.col("p_type").alias("icao_desc")
    )


def operational_flights(
    spark: SparkSession, folder: str, nameless: str | None = None
) -> DataFrame:
    """``nameless`` is a nation whose airport code is missing on the flights."""
    names = table(spark, folder, "nation").select(
        "n_nationkey", F.nullif(F.col("n_name"), F.lit(nameless or ""))
    )
    return shipments(spark, folder, names).select(
        F.col("l_orderkey").alias("flt_uid"),
        F.col("o_orderdate").alias("flt_lobt"),
        F.col("l_shipdate").alias("flt_a_asp_prof_time_entry"),
        F.col("from_name").alias("flt_dep_ad"),
        F.col("to_name").alias("flt_ctfm_ades"),
        F.col("o_orderstatus").alias("flt_state"),
    )


def nations(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region")
    joined = table(spark, folder, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.select("n_nationkey", "n_name", "r_name")


def airports(spark: SparkSession, folder: str, unknown: str | None = None) -> DataFrame:
    """Nations as airports in regions as countries; ``unknown`` has the code for no country."""
    country = F.when(F.col("n_name") == F.lit(unknown), "##").otherwise(F.col("r_name"))
    return nations(spark, folder).select(
        F.col("n_nationkey").alias("sk_ap_id"),
        F.col("n_name").alias("icao_ap_code"),
        country.alias("ec_iso_ct_code"),
        F.col("n_name").alias("iso_ct_code"),
    )


def national_airports(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as airports that are countries of their own."""
    return nations(spark, folder).select(
        F.col("n_nationkey").alias("sk_ap_id"),
        F.col("n_name").alias("icao_ap_code"),
        F.col("n_name").alias("ec_iso_ct_code"),
        F.col("n_name").alias("iso_ct_code"),
    )


def customer_airports(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as airports, with made-up coordinates."""
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_name").alias("icao_ap_code"),
        F.lower("c_name").alias("icao_ap_name"),
        F.substring("c_mktsegment", 1, 3).alias("iata_ap_code"),
        F.col("c_mktsegment").alias("iata_ap_name"),
        longitude().alias("longitude"),
        latitude().alias("latitude"),
        F.col("c_nationkey").cast("string").alias("iso_ct_code"),
        F.concat(F.lit("nation "), F.col("c_nationkey")).alias("iso_ct_name"),
    )


def dated_customer_airports(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as airports that are valid from their first order to their last."""
    spans = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("valid_from"), F.max("o_orderdate").alias("valid_to"))
    )
    return customer_airports(spark, folder).join(spans, "c_custkey")


def longitude() -> Column:
    """-180 to 180 in steps of one degree, missing at 0."""
    degrees = (F.col("c_custkey") * 7) % 361 - 180
    return F.nullif(degrees, F.lit(0)).cast("double")


def latitude() -> Column:
    """-90 to 90 in steps of one degree."""
    return ((F.col("c_custkey") * 13) % 181 - 90).cast("double")


def airport_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as a version of its nation's airport, valid for a day per unit of balance.

    Pairs of neighbouring nations share a country; the last nation has no airport record.
    """
    number = F.floor(F.col("n_nationkey") / 2)
    country = F.concat(F.lit("C"), F.lpad(number.cast("string"), 2, "0"))
    return (
        table(spark, folder, "customer")
        .join(nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.nullif(F.col("n_name"), F.lit("NATION_24")).alias("cfmu_ap_code"),
            F.concat("n_name", F.lit(" "), "c_mktsegment").alias("cfmu_ap_name"),
            F.concat("r_name", F.lit("-D'ARC ("), country, F.lit(")")).alias("iso_ct_name"),
            country.alias("iso_ct_code"),
            (F.col("n_nationkey") * 3 - 35).cast("double").alias("latitude"),
            (F.col("n_nationkey") * 10 - 120).cast("double").alias("longitude"),
            F.date_add(F.lit("2000-01-01").cast("date"), F.floor("c_acctbal").cast("int")).alias(
                "valid_to"
            ),
        )
    )


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    """A centroid per country of ``airport_versions``."""
    versions = airport_versions(spark, folder).where(F.col("cfmu_ap_code").isNotNull())
    return (
        versions.groupBy(F.col("iso_ct_code").alias("iso_a2"))
        .agg(F.min("longitude").alias("longitude"), F.min("latitude").alias("latitude"))
        .select(
            F.concat(F.lit("Land "), F.col("iso_a2")).alias("name"),
            F.lit(None).cast("string").alias("iso_a3"),
            "iso_a2",
            "longitude",
            "latitude",
        )
    )


def customer_countries(spark: SparkSession, folder: str) -> DataFrame:
    """Nations that have customers, with their region."""
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("n_nationkey"))
    return (
        nations(spark, folder)
        .join(customers.distinct(), "n_nationkey")
        .select(F.col("n_name").alias("name"), F.col("r_name").alias("region"))
    )


def classification(spark: SparkSession, folder: str) -> DataFrame:
    """Nations by region; one nation is missing."""
    return nations(spark, folder).where(F.col("n_name") != "NATION_12").select(
        F.col("n_name").alias("iso2c"),
        F.concat(F.lit("Land "), F.col("n_nationkey")).alias("country_name"),
        F.col("r_name").alias("home_region"),
        F.concat(
            "r_name", F.when(F.col("n_nationkey") < 13, " north").otherwise(" south")
        ).alias("sub_region"),
    )


def raw_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly flows between nations over all time."""
    return country_flows(
        flights(spark, folder),
        national_airports(spark, folder),
        aircraft_types(spark, folder),
        *OPEN,
        **EXCLUSIONS,
    )


def years(spark: SparkSession, folder: str) -> list[int]:
    """The years that orders can fall in, from the first to the last of the table."""
    date = F.col("o_orderdate")
    first, last = table(spark, folder, "orders").agg(F.year(F.min(date)), F.year(F.max(date))).first()
    return [] if first is None else list(range(first, last + 1))


def nation_names(spark: SparkSession, folder: str) -> list[str]:
    """The names that become columns, from their dimension."""
    return sorted_values(table(spark, folder, "nation"), "n_name")


def gappy_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Raw flows on which one departure and one destination code are missing."""
    return raw_flows(spark, folder).withColumns(
        {
            "dep_iso_country_code": F.nullif(F.col("dep_iso_country_code"), F.lit("NATION_5")),
            "des_iso_country_code": F.nullif(F.col("des_iso_country_code"), F.lit("NATION_6")),
        }
    )


def classified_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Prepared flows with the home scheme's regions; the missing nation's are NULL."""
    return with_region(
        prepare_columns(raw_flows(spark, folder)), classification(spark, folder), "home_region"
    )


def classified_gappy_flows(spark: SparkSession, folder: str) -> DataFrame:
    """As ``classified_flows``, then one origin code is lost while its region stays."""
    return classified_flows(spark, folder).withColumn(
        "origin_iso", F.nullif(F.col("origin_iso"), F.lit("NATION_9"))
    )
