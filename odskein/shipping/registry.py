"""One query per operator over the trade tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odskein.functions.period import Period
from odskein.operators import (
    checks,
    extracts,
    flowmap,
    graph,
    intervals,
    lists,
    matrices,
    recode,
    regions,
    tiles,
    versions,
    yearly,
)
from odskein.plans.circular import publish_chart
from odskein.plans.daily_map import map_timeline, publish_map
from odskein.plans.daily_table import daily_flows, update_daily_flows
from odskein.schemas import CENTROIDS, OVERRIDES
from odskein.shipping import roles
from odskein.sinks.files import write_csv
from odskein.sinks.manifests import new_name, published
from odskein.sinks.scratch import scratch_folder
from odskein.sources import delimited
from odskein.sources.bucketed import write_star
from odskein.sources.literals import inline_rows
from odskein.sources.quarantine import read_checked
from odskein.sources.tables import bound_query
from odskein.streaming.daily import Events, FollowedDays, closing_days, follow_days

# Thresholds of 7 and 12 flights a year, as the operators take them: per day.
MATRIX_FPD = 7 / 365
CHART_FPD = 12 / 365
GRAPH_YEAR = 1998

# Places of the trade map that have no centroid, or another one.
EXTRA_PLACES = [("Far place", None, "C03", 44.5, -12.5), ("Unused place", None, "##", 0.0, 0.0)]
MOVED_PLACES = [("C05", "Moved place", 1.25, 2.5), ("C06", None, -3.5, 4.0)]

# The part of the trade map that is shown, and the squares its matrix is cut into.
MAP_BOX = yearly.BoundingBox(-45, -12.5, 62.5, 14)
TILE_SIDE = 8
BUCKETS = 8
# Off-block days at which the deliveries of flights begin.
DELIVERIES = ("1996-07-01", "1999-01-01")
EVENTS = Events("event_id", "ts", ("event_type",))

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _star(spark: SparkSession, folder: str, **options):
    return (
        roles.flights(spark, folder),
        roles.airports(spark, folder, **options),
        roles.aircraft_types(spark, folder),
    )


@query
def country_flows(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.country_flows(*_star(spark, folder), *roles.ALL_TIME, **roles.EXCLUSIONS)


@query
def country_flows_split_key(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.country_flows(
        *_star(spark, folder), *roles.ALL_TIME, split_key=True, **roles.EXCLUSIONS
    )


@query
def country_flows_known_only(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.country_flows(
        *_star(spark, folder, unknown="NATION_11"), *roles.ALL_TIME, **roles.EXCLUSIONS
    )


@query
def airport_flows_instant(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.airport_flows(*_star(spark, folder), *roles.ALL_TIME, **roles.EXCLUSIONS)


@query
def airport_flows_year(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.airport_flows(
        *_star(spark, folder, unknown="NATION_11"),
        *roles.TWO_YEARS,
        grain="year",
        **roles.EXCLUSIONS,
    )


@query
def airports_valid(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.airports_valid(roles.dated_customer_airports(spark, folder), *roles.TWO_YEARS)


@query
def daily_airport_flows(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder, roles.ALL_TIME)


@query
def daily_airport_flows_period(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder, roles.TWO_YEARS, nameless="NATION_7")


def _daily(spark: SparkSession, folder: str, period, nameless: str | None = None) -> DataFrame:
    return extracts.daily_airport_flows(
        roles.operational_flights(spark, folder, nameless),
        roles.airport_versions(spark, folder),
        *period,
        states=roles.STATES,
    )


@query
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    orders = roles.table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"
    )
    return versions.latest_version(orders, "o_custkey", "o_orderdate")


@query
def current_airports(spark: SparkSession, folder: str) -> DataFrame:
    return versions.current_airports(roles.airport_versions(spark, folder))


@query
def recode_country(spark: SparkSession, folder: str) -> DataFrame:
    return recode.recode_country(roles.gappy_flows(spark, folder), roles.RETIRED_CODES)


@query
def recode_country_merged(spark: SparkSession, folder: str) -> DataFrame:
    recoded = recode.recode_country(roles.gappy_flows(spark, folder), roles.RETIRED_CODES)
    return recode.merge_flows(recoded, "nb_of_flight")


@query
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    recoded = recode.recode_country(roles.gappy_flows(spark, folder), roles.RETIRED_CODES)
    return checks.duplicate_keys(
        recoded, ["year", "dep_iso_country_code", "des_iso_country_code"]
    )


@query
def fix_region(spark: SparkSession, folder: str) -> DataFrame:
    return recode.fix_region(roles.classified_gappy_flows(spark, folder), roles.LATE_REGIONS)


@query
def fix_home_region(spark: SparkSession, folder: str) -> DataFrame:
    return recode.fix_home_region(
        roles.classified_gappy_flows(spark, folder), roles.LATE_REGIONS, roles.LATE_NAMES
    )


@query
def collapse_regions(spark: SparkSession, folder: str) -> DataFrame:
    return recode.collapse_regions(roles.classified_flows(spark, folder), roles.WIDE_REGIONS)


@query
def with_region(spark: SparkSession, folder: str) -> DataFrame:
    return roles.classified_flows(spark, folder)


def _split(spark: SparkSession, folder: str) -> regions.FlowSplit:
    return regions.split_intra_extra(roles.classified_flows(spark, folder), roles.HOME)


@query
def intra_flows(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).intra


@query
def extra_flows(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).extra


@query
def overflights(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).over


@query
def flow_class_totals(spark: SparkSession, folder: str) -> DataFrame:
    return regions.flow_class_totals(roles.classified_flows(spark, folder), roles.HOME)


def _wide_extra(spark: SparkSession, folder: str) -> DataFrame:
    return recode.collapse_regions(_split(spark, folder).extra, roles.WIDE_REGIONS)


@query
def year_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return matrices.year_matrix(_wide_extra(spark, folder), roles.years(spark, folder), MATRIX_FPD)


def _intra_matrix(spark: SparkSession, folder: str) -> DataFrame:
    intra = regions.with_region(
        _split(spark, folder).intra, roles.classification(spark, folder), "sub_region"
    )
    return matrices.year_matrix(intra, roles.years(spark, folder))


@query
def intra_year_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _intra_matrix(spark, folder)


@query
def pair_totals_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return matrices.pair_totals_by_year(_wide_extra(spark, folder), roles.years(spark, folder))


@query
def region_pair_stats(spark: SparkSession, folder: str) -> DataFrame:
    return matrices.region_pair_stats(_wide_extra(spark, folder))


@query
def visible_countries(spark: SparkSession, folder: str) -> DataFrame:
    return lists.visible_countries(_wide_extra(spark, folder), show=0)


@query
def visible_regions(spark: SparkSession, folder: str) -> DataFrame:
    return lists.visible_regions(_wide_extra(spark, folder))


@query
def visible_years(spark: SparkSession, folder: str) -> DataFrame:
    return lists.visible_years(_wide_extra(spark, folder))


@query
def top_contributors(spark: SparkSession, folder: str) -> DataFrame:
    matrix = matrices.year_matrix(_wide_extra(spark, folder), roles.years(spark, folder))
    return lists.top_contributors(matrix, "countryflow_1998", roles.HOME, n=30)


@query
def missing_code_audit(spark: SparkSession, folder: str) -> DataFrame:
    return lists.missing_code_audit(roles.gappy_flows(spark, folder))


@query
def missing_code_totals(spark: SparkSession, folder: str) -> DataFrame:
    return lists.missing_code_totals(roles.gappy_flows(spark, folder))


@query
def drop_missing_codes(spark: SparkSession, folder: str) -> DataFrame:
    return lists.drop_missing_codes(roles.gappy_flows(spark, folder))


def _graph(spark: SparkSession, folder: str) -> graph.FlowGraph:
    flows = recode.prepare_columns(roles.raw_flows(spark, folder))
    return graph.od_graph(flows, GRAPH_YEAR, MATRIX_FPD)


@query
def od_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return _graph(spark, folder).nodes


@query
def od_links(spark: SparkSession, folder: str) -> DataFrame:
    return _graph(spark, folder).links


def _map_flows(spark: SparkSession, folder: str) -> DataFrame:
    daily = _daily(spark, folder, roles.OPEN)
    return flowmap.repair_country(daily, "NATION_7", "C09")


@query
def repair_country(spark: SparkSession, folder: str) -> DataFrame:
    return _map_flows(spark, folder).select(
        "entry_day", "adep", "ades", "flight", "adep_country_iso_code", "ades_country_iso_code"
    )


@query
def country_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return flowmap.country_pairs(_map_flows(spark, folder))


@query
def locations(spark: SparkSession, folder: str) -> DataFrame:
    return flowmap.locations(
        flowmap.country_pairs(_map_flows(spark, folder)),
        roles.centroids(spark, folder),
        inline_rows(spark, CENTROIDS, EXTRA_PLACES),
        inline_rows(spark, OVERRIDES, MOVED_PLACES),
    )


@query
def flow_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return map_timeline(
        _map_flows(spark, folder),
        roles.centroids(spark, folder),
        inline_rows(spark, CENTROIDS, EXTRA_PLACES),
        inline_rows(spark, OVERRIDES, MOVED_PLACES),
        threshold=2,
        repair=None,
    )


@query
def day_list(spark: SparkSession, folder: str) -> DataFrame:
    return lists.day_list(_map_flows(spark, folder))


def _yearly_flows(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.airport_flows(
        *_star(spark, folder),
        *roles.OPEN,
        grain="year",
        ordered=False,
        **roles.EXCLUSIONS,
    )


@query
def departure_share(spark: SparkSession, folder: str) -> DataFrame:
    return yearly.departure_share(_yearly_flows(spark, folder))


@query
def airport_points(spark: SparkSession, folder: str) -> DataFrame:
    airports = roles.customer_airports(spark, folder).drop("c_custkey")
    return yearly.airport_points(airports, yearly.EUROPE)


@query
def region_countries(spark: SparkSession, folder: str) -> DataFrame:
    countries = roles.customer_countries(spark, folder)
    return yearly.region_countries(countries, roles.HOME, ("NATION_13",))


@query
def pair_points(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _yearly_flows(spark, folder).select("year", "adep", "ades", "nb_of_flight")
    points = versions.current_airports(roles.airport_versions(spark, folder)).select(
        F.col("cfmu_ap_code").alias("icao"), "longitude", "latitude"
    )
    return yearly.pair_points(pairs, points.distinct())


@query
def od_matrix(spark: SparkSession, folder: str) -> DataFrame:
    flows = recode.prepare_columns(roles.raw_flows(spark, folder))
    return matrices.od_matrix(flows, roles.nation_names(spark, folder))


@query
def od_matrix_gappy(spark: SparkSession, folder: str) -> DataFrame:
    flows = recode.prepare_columns(roles.gappy_flows(spark, folder))
    return matrices.od_matrix(flows, roles.nation_names(spark, folder))


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Codes repaired, rows without one dropped, keys that became equal added up."""
    raw = lists.drop_missing_codes(
        recode.recode_country(roles.gappy_flows(spark, folder), roles.RETIRED_CODES)
    )
    return recode.merge_flows(recode.prepare_columns(raw), "flights")


@query
def chart_matrix(spark: SparkSession, folder: str) -> DataFrame:
    flows = recode.fix_home_region(
        regions.with_region(_cleaned(spark, folder), roles.classification(spark, folder), "home_region"),
        roles.LATE_REGIONS,
        roles.LATE_NAMES,
    )
    extra = recode.collapse_regions(regions.split_intra_extra(flows, roles.HOME).extra, roles.WIDE_REGIONS)
    return matrices.year_matrix(extra, roles.years(spark, folder), CHART_FPD)


@query
def un_regions(spark: SparkSession, folder: str) -> DataFrame:
    flows = regions.with_region(
        _cleaned(spark, folder), roles.classification(spark, folder), "sub_region"
    )
    return recode.fix_region(flows, roles.LATE_REGIONS)


@query
def intra_countries(spark: SparkSession, folder: str) -> DataFrame:
    return lists.visible_countries(_intra_matrix(spark, folder), show=1)


@query
def intra_regions(spark: SparkSession, folder: str) -> DataFrame:
    return lists.visible_regions(_intra_matrix(spark, folder))


@query
def intra_contributors(spark: SparkSession, folder: str) -> DataFrame:
    return lists.top_contributors(_intra_matrix(spark, folder), "countryflow_1998", roles.HOME, n=2)


@query
def yearly_map_lines(spark: SparkSession, folder: str) -> DataFrame:
    points = versions.current_airports(roles.airport_versions(spark, folder)).select(
        F.col("cfmu_ap_code").alias("icao"), "longitude", "latitude"
    )
    return yearly.pair_points(yearly.departure_share(_yearly_flows(spark, folder)), points.distinct())


@query
def airports_valid_codes(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.airports_valid(
        roles.dated_customer_airports(spark, folder), *roles.TWO_YEARS, codes=roles.SOME_AIRPORTS
    )


@query
def country_flows_blank(spark: SparkSession, folder: str) -> DataFrame:
    """Flights whose type is blank, and airports whose country is."""
    flights = roles.flights(spark, folder).replace({"A": ""}, subset=["icao_flt_type"])
    airports = roles.airports(spark, folder).replace({"ASIA": ""}, subset=["ec_iso_ct_code"])
    return extracts.country_flows(
        flights, airports, roles.aircraft_types(spark, folder), *roles.OPEN, **roles.EXCLUSIONS
    )


@query
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written as CSV text and read back, with the form that files have."""
    rows = roles.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("code"),
        F.concat(F.lit('  "'), "c_name", F.lit('", of "'), "c_mktsegment", F.lit('" ')).alias("label"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
    )
    schema = "code string, label string, segment string"
    text = F.to_csv(F.struct(*rows.columns), delimited.CSV_FORM)
    back = rows.select(F.from_csv(text, F.lit(schema), delimited.CSV_FORM).alias("row"))
    return back.select("row.*").select(delimited.whole_number("code").alias("code"), "label", "segment")


@query
def bound_sql(spark: SparkSession, folder: str) -> DataFrame:
    text = """
        SELECT o_orderstatus AS flt_state, count(o_orderkey) AS flights
        FROM {orders}
        WHERE o_orderdate >= to_timestamp_ntz(:wef, "yyyy-MM-dd'T'HH:mm:ss'Z'")
          AND o_orderdate < to_timestamp_ntz(:til, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        GROUP BY o_orderstatus
    """
    return bound_query(
        spark, text, Period.of(*roles.ALL_TIME), orders=roles.table(spark, folder, "orders")
    )


@query
def version_faults(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.version_faults(roles.order_versions(spark, folder), ["code"], "valid_from", "valid_to")


@query
def versions_in_force(spark: SparkSession, folder: str) -> DataFrame:
    airports = roles.dated_customer_airports(spark, folder)
    return intervals.versions_in_force(airports, ["iso_ct_code"], "valid_from", "valid_to")


@query
def clipped_map_lines(spark: SparkSession, folder: str) -> DataFrame:
    return yearly.clip_lines(yearly_map_lines(spark, folder), MAP_BOX)


@query
def od_tile_totals(spark: SparkSession, folder: str) -> DataFrame:
    flows = recode.prepare_columns(roles.gappy_flows(spark, folder))
    return tiles.tile_totals(tiles.od_tiles(flows, side=TILE_SIDE))


@query
def od_tile_cells(spark: SparkSession, folder: str) -> DataFrame:
    flows = recode.prepare_columns(roles.gappy_flows(spark, folder))
    return tiles.od_cells(tiles.od_tiles(flows, side=TILE_SIDE))


@query
def followed_event_days(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of events counted per day and type, as the table holds it when all has arrived."""
    place = scratch_folder(spark, "followed")
    table = FollowedDays(spark, f"{place}/table", EVENTS, "event_type string")
    follow_days(roles.event_stream(spark, folder), table, f"{place}/checkpoint")
    return table.counts()


@query
def closed_event_days(spark: SparkSession, folder: str) -> DataFrame:
    """The days of the stream of events that have closed two days behind its last one."""
    place = scratch_folder(spark, "closing")
    counted = closing_days(roles.event_stream(spark, folder), EVENTS, "2 days")
    files = counted.writeStream.format("parquet").option("path", f"{place}/days")
    files.option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("entry_day date, event_type string, n_events bigint").parquet(f"{place}/days")


@query
def incremental_daily_flows(spark: SparkSession, folder: str) -> DataFrame:
    """The daily extract after three deliveries of flights, each of which touches days of the one before."""
    place = scratch_folder(spark, "daily")
    flights, airports = roles.operational_flights(spark, folder), roles.airport_versions(spark, folder)
    periods = [Period.of(*bounds) for bounds in zip((None, *DELIVERIES), (*DELIVERIES, None))]
    for period in periods:
        known = flights.where(Period(None, period.til).holds(flights, "flt_lobt"))
        new = flights.where(period.holds(flights, "flt_lobt"))
        update_daily_flows(place, known, new, airports, states=roles.STATES, look_back=None, unit="month")
    return daily_flows(spark, place, unit="month")


@query
def checked_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A file with spoilt fields, by what became of its lines."""
    place = scratch_folder(spark, "checked")
    key = F.col("c_custkey")
    number = F.when(key % 5 == 0, F.concat(key, F.lit("x"))).when(key % 5 == 1, F.concat(key, F.lit("e2")))
    spoilt = roles.table(spark, folder, "customer").select(
        F.coalesce(number, key.cast("string")).alias("code"),
        F.when(key % 7 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("decimal(12, 2)").cast("string")).alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    write_csv(spoilt, f"{place}/rows")
    checked = read_checked(spark, f"{place}/rows", StructType.fromDDL("code bigint, balance decimal(12, 2), segment string"))
    good = checked.rows.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum("code").alias("codes"))
    reason = F.regexp_extract("reason", "^(.*?)(?:: .*)?$", 1)
    bad = checked.rejected.groupBy(reason.alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad.withColumn("codes", F.lit(None).cast("bigint")))


@query
def published_chart(spark: SparkSession, folder: str) -> DataFrame:
    """The inner flows of a chart, from its published package."""
    place = scratch_folder(spark, "chart")
    raw, scheme = roles.gappy_flows(spark, folder), roles.classification(spark, folder)
    publish_chart(raw, scheme, roles.HOME, place, roles.years(spark, folder))
    return published(spark, place, "intra-flows")


@query
def published_map(spark: SparkSession, folder: str) -> DataFrame:
    """The timeline of a map, from its published package."""
    place = scratch_folder(spark, "map")
    publish_map(
        _map_flows(spark, folder),
        roles.centroids(spark, folder),
        place,
        2,
        inline_rows(spark, CENTROIDS, EXTRA_PLACES),
        inline_rows(spark, OVERRIDES, MOVED_PLACES),
        repair=None,
    )
    return published(spark, place, "flows")


@query
def bucketed_country_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly flows between countries from a star stored in buckets."""
    flights, airports, types = _star(spark, folder)
    civil = extracts.civil_flights(flights, types, Period.of(*roles.ALL_TIME), **roles.EXCLUSIONS)
    name = new_name("star").replace("-", "_")
    star = write_star(spark, civil, airports, name, scratch_folder(spark, "star"), BUCKETS)
    return extracts.count_countries(star.flights, star.airports)
