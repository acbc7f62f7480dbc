import pytest
from pyspark.sql import functions as F

from odskein.functions.period import Period
from odskein.operators.checks import duplicate_keys, sorted_values, unique_lookup
from odskein.operators.extracts import (
    airport_flows,
    airports_valid,
    country_flows,
    daily_airport_flows,
)
from odskein.operators.versions import current_airports, latest_version
from tests.frames import aircraft, airports, at, flights, operational, rows

PLACES = [
    {"icao_ap_code": "EBBR", "ec_iso_ct_code": "BE", "iso_ct_code": "BE"},
    {"icao_ap_code": "LFPG", "ec_iso_ct_code": "FR", "iso_ct_code": "FR"},
    {"icao_ap_code": "LFXX", "ec_iso_ct_code": "FR", "iso_ct_code": "XF"},
    {"icao_ap_code": "ZZZZ", "ec_iso_ct_code": "##", "iso_ct_code": "##"},
    {"icao_ap_code": "AFIL", "ec_iso_ct_code": None, "iso_ct_code": None},
]


def flight(uid, lobt="2001-06-01", dep=0, des=1, kind="A1", use="S"):
    return (uid, lobt, dep, des, kind, use)


def star(spark, data):
    return flights(spark, data), airports(spark, PLACES), aircraft(spark)


def test_country_flows_exclusions(spark):
    data = [
        flight("kept"),
        flight("first instant", "2001-01-01"),
        flight("before", "2000-12-31T23:59:59"),
        flight("end", "2002-01-01"),
        flight("military", use="M"),
        flight("no use", use=None),
        flight("helicopter", kind="H1"),
        flight("blank type", kind="B1"),
        flight("null type", kind="N1"),
        flight("unlisted type", kind="ZZ"),
        flight("unknown country", des=3),
        flight("null country", des=4),
        flight("no departure", dep=None),
        flight(None),
    ]
    types = aircraft(spark, [("A1", "L2J"), ("H1", "H2T"), ("B1", ""), ("N1", None)])
    found = country_flows(flights(spark, data), airports(spark, PLACES), types, "2001", "2002")
    assert found.columns == [
        "year",
        "nb_of_flight",
        "dep_iso_country_code",
        "des_iso_country_code",
    ]
    assert rows(found) == [("2001", 2, "BE", "FR")]


def test_flights_without_an_id_make_a_row_but_no_count(spark):
    found = country_flows(*star(spark, [flight(None)]), "2001", "2002")
    assert rows(found) == [("2001", 0, "BE", "FR")]


def test_hidden_key_splits_the_departure_side(spark):
    data = [flight("a", dep=1, des=0), flight("b", dep=2, des=0), flight("c", dep=0, des=2)]
    whole = country_flows(*star(spark, data), "2001", "2002")
    assert rows(whole) == [("2001", 1, "BE", "FR"), ("2001", 2, "FR", "BE")]
    split = country_flows(*star(spark, data), "2001", "2002", split_key=True)
    assert rows(split) == [("2001", 1, "BE", "FR")] + 2 * [("2001", 1, "FR", "BE")]


def test_repeated_aircraft_type_counts_twice(spark):
    types = aircraft(spark, [("A1", "L2J"), ("A1", "L4J")])
    found = country_flows(
        flights(spark, [flight("a")]), airports(spark, PLACES), types, "2001", "2002"
    )
    assert rows(found) == [("2001", 2, "BE", "FR")]


def test_airport_flows_grains(spark):
    data = [
        flight("a", "2001-06-01T10:00:00"),
        flight("b", "2001-06-01T10:00:00"),
        flight("c", "2001-06-01T11:00:00"),
        flight("d", "2001-07-01", des=3),
    ]
    instant = airport_flows(*star(spark, data), "2001", "2002")
    assert [r.nb_of_flight for r in instant.collect()] == [2, 1, 1]
    assert rows(instant, "year", "adep", "ades", "nb_of_flight") == [
        ("2001", "EBBR", "LFPG", 1),
        ("2001", "EBBR", "LFPG", 2),
        ("2001", "EBBR", "ZZZZ", 1),
    ]
    yearly = airport_flows(*star(spark, data), "2001", "2002", grain="year", drop_unknown=True)
    assert rows(yearly) == [("2001", 3, "EBBR", "BE", "LFPG", "FR")]
    assert dict(yearly.dtypes)["nb_of_flight"] == "bigint"
    with pytest.raises(ValueError):
        airport_flows(*star(spark, data), "2001", "2002", grain="day")


def test_airports_valid(spark):
    data = [
        {"icao_ap_code": "B", "valid_from": "2001-01-01", "valid_to": "2003-01-01"},
        {"icao_ap_code": "A", "valid_from": "2000-01-01", "valid_to": "2002-01-02"},
        {"icao_ap_code": "ends with the period", "valid_from": "2000-01-01",
         "valid_to": "2002-01-01"},
        {"icao_ap_code": "starts late", "valid_from": "2001-01-02", "valid_to": "2003-01-01"},
        {"icao_ap_code": "open", "valid_from": "2000-01-01", "valid_to": None},
    ]
    frame = airports(spark, data)
    found = airports_valid(frame, "2001", "2002")
    assert [r.icao for r in found.collect()] == ["A", "B"]
    assert found.columns[:4] == ["icao", "name", "iata_code", "iata_name"]
    assert rows(airports_valid(frame, "2001", "2002", codes=["B"]), "icao") == [("B",)]


def version(code, valid_to, name="x", country="C", **more):
    return {
        "cfmu_ap_code": code,
        "cfmu_ap_name": name,
        "iso_ct_name": country,
        "valid_to": valid_to,
        **more,
    }


def test_latest_version_keeps_ties(spark):
    data = [
        version("AAAA", "2001-01-01", "old"),
        version("AAAA", "2002-01-01", "new"),
        version("AAAA", None, "undated"),
        version("BBBB", "2002-01-01", "one"),
        version("BBBB", "2002-01-01", "two"),
        version("CCCC", None, "never dated"),
        version(None, "2002-01-01", "no code"),
    ]
    found = latest_version(airports(spark, data), "cfmu_ap_code", "valid_to")
    assert rows(found, "cfmu_ap_name") == [("new",), ("one",), ("two",)]


def test_current_airports_repairs_and_drops_copies(spark):
    data = [
        version("AAAA", "2002-01-01"),
        version("AAAA", "2002-01-01"),
        version("WIII", "2002-01-01"),
        version("xWI", "2002-01-01"),
        version("xWR", "2002-01-01"),
        version("XSPR", "2002-01-01"),
        version("", "2002-01-01"),
    ]
    frame = airports(spark, data)
    found = rows(current_airports(frame), "cfmu_ap_code", "icao_ctry_code", "iso_ct_name")
    assert found == [
        ("AAAA", "AA", "C"),
        ("WIII", "WI", "C"),
        ("XSPR", "XS", "CUBA"),
        ("xWI", "xW", "INDONESIA"),
        ("xWR", "xW", "INDONESIA"),
    ]
    meant = rows(current_airports(frame, prefix_repair=True), "cfmu_ap_code", "iso_ct_name")
    assert meant == [
        ("AAAA", "C"),
        ("WIII", "INDONESIA"),
        ("XSPR", "CUBA"),
        ("xWI", "C"),
        ("xWR", "C"),
    ]


def test_daily_flows_two_clocks_and_states(spark):
    def leg(uid, lobt, entry, state="TE"):
        return (uid, lobt, entry, "A", "B", state)

    data = [
        leg("look back", "2000-12-31T23:00:00", "2001-01-01T00:30:00"),
        leg("too early", "2000-12-30T23:00:00", "2001-01-01T00:40:00"),
        leg("entered before", "2001-01-01", "2000-12-31T23:00:00"),
        leg("entry at end", "2001-01-01T23:00:00", "2001-01-02T00:00:00"),
        leg("same day", "2001-01-01T09:00:00", "2001-01-01T10:00:00", "AA"),
        leg("other state", "2001-01-01T09:00:00", "2001-01-01T10:00:00", "CA"),
    ]
    found = daily_airport_flows(
        operational(spark, data), airports(spark, []), "2001-01-01", "2001-01-02"
    )
    assert rows(found, F.col("entry_day").cast("string"), "flight") == [("2001-01-01", 2)]
    assert len(found.columns) == 16


def test_daily_flows_missing_ends_and_tied_versions(spark):
    def leg(uid, dep, des):
        return (uid, "2001-01-01T01:00:00", "2001-01-01T02:00:00", dep, des, "TA")

    legs = operational(spark, [leg("1", "B", "A"), leg("2", None, "A"), leg("3", None, None)])
    dim = airports(
        spark,
        [version("A", "2002-01-01", "one"), version("A", "2002-01-01", "two"),
         version("B", "2002-01-01", "b")],
    )
    found = daily_airport_flows(legs, dim, "2001-01-01", "2001-01-02")
    assert rows(
        found, "adep_ades_pair_code", "airport_pair_code", "flight", "adep_name", "ades_name"
    ) == [
        (">", "<->", 1, None, None),
        (">A", "<->", 1, None, "one"),
        (">A", "<->", 1, None, "two"),
        ("B>A", "A<->B", 1, "b", "one"),
        ("B>A", "A<->B", 1, "b", "two"),
    ]


def test_counts_beyond_32_bits_and_blank_text(spark):
    from odskein.operators.yearly import departure_share

    big = spark.createDataFrame([("2017", 3_000_000_000, "A", "B")], "year string, nb_of_flight bigint, adep string, ades string")
    assert rows(departure_share(big)) == [("2017", 3_000_000_000, "A", "B", 3_000_000_000)]
    data = [flight("a", "2001-06-01"), flight("b", "2001-06-01")]
    flights, places, types = star(spark, data)
    blank = flights.withColumn("icao_flt_type", F.when(F.col("flt_uid") == "a", "").otherwise(F.col("icao_flt_type")))
    assert [r.nb_of_flight for r in country_flows(blank, places, types, None, None).collect()] == [1]


def test_open_and_empty_periods(spark):
    data = [flight("a", "1901-06-01"), flight("b", "2101-06-01")]
    assert {r.year for r in country_flows(*star(spark, data), None, None).collect()} == {"1901", "2101"}
    assert {r.year for r in country_flows(*star(spark, data), "2000", None).collect()} == {"2101"}
    with pytest.raises(ValueError, match="ends before"):
        country_flows(*star(spark, data), "2002", "2001")
    with pytest.raises(ValueError, match="both bounds"):
        Period.of(None, "2001").years()


def test_key_checks(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    assert rows(duplicate_keys(frame, ["k"])) == [("a", 2)]
    with pytest.raises(Exception, match="several rows for k a"):
        unique_lookup(frame, "k", ["v"]).collect()
    assert rows(unique_lookup(frame.where("v <> 2"), "k", ["v"])) == [("a", 1), ("b", 3)]
    assert sorted_values(frame, "v") == [1, 2, 3, 4]


def test_instants_of_a_busy_pair_are_spread_by_the_sort(spark):
    data = [flight(str(i), at("2001-01-01").replace(minute=i % 60, hour=i // 60).isoformat())
            for i in range(600)]
    found = airport_flows(*star(spark, data), "2001", "2002")
    assert found.count() == 600
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "time_key" in plan.split("Sort [")[1].split("]")[0]


def test_years_and_days_are_utc_whatever_the_session_clock(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        late = spark.sql("""
            SELECT '1' AS flt_uid, timestamp'2001-01-01T01:00:00Z' AS lobt, 0L AS sk_adep_id,
                   1L AS sk_ades_id, 'A1' AS aircraft_type_icao_id, 'S' AS icao_flt_type""")
        legs = spark.sql("""
            SELECT '1' AS flt_uid, timestamp'2001-01-01T01:00:00Z' AS flt_lobt,
                   timestamp'2001-01-01T02:00:00Z' AS flt_a_asp_prof_time_entry,
                   'A' AS flt_dep_ad, 'B' AS flt_ctfm_ades, 'TE' AS flt_state""")
        dim, types = airports(spark, PLACES), aircraft(spark)
        yearly = country_flows(late, dim, types, "2001", "2002")
        instants = airport_flows(late, dim, types, "2001", "2002")
        days = daily_airport_flows(legs, airports(spark, []), "2001-01-01", "2001-01-02")
        assert rows(yearly, "year", "nb_of_flight") == [("2001", 1)]
        assert rows(instants, "year", "nb_of_flight") == [("2001", 1)]
        assert rows(days, F.col("entry_day").cast("string"), "flight") == [("2001-01-01", 1)]
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
