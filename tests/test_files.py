import gzip
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from odskein import schemas
from odskein.functions.period import Period
from odskein.operators import flowmap, lists
from odskein.operators.extracts import country_flows, daily_airport_flows
from odskein.operators.graph import od_graph
from odskein.plans import circular, daily_map, yearly_map
from odskein.shipping import roles
from odskein.sinks import files
from odskein.sources import delimited, extracts, tables
from odskein.sources.literals import inline_rows
from tests.frames import aircraft, airports, country_rows, flights, operational, rows

PERIOD = Period.of("2020-01-01", "2020-10-13")


def write(path, text, opener=open):
    with opener(path, "wt", encoding="utf-8") as file:
        file.write(text)
    return str(path)


def test_raw_flows_keep_namibia(spark, tmp_path):
    path = write(
        tmp_path / "raw.csv",
        "YEAR,NB_OF_FLIGHT,DEP_ISO_COUNTRY_CODE,DES_ISO_COUNTRY_CODE\n"
        "2014,5,NA,FR\n2014,6,,FR\n",
    )
    found = delimited.read_raw_flows(spark, path)
    assert found.schema == schemas.RAW_FLOWS_CSV
    assert rows(found) == [(2014, 5, "NA", "FR"), (2014, 6, None, "FR")]


def test_whole_numbers_in_scientific_notation(spark, tmp_path):
    header = ",".join(schemas.FLOW_TEXT_COLUMNS + ["countryflow_2014", "countryflow_2015"])
    path = write(
        tmp_path / "flows.csv",
        f'{header}\nKR,"Korea, Republic of",Asia,NA,Namibia,Africa,4e3,\n',
    )
    found = delimited.read_whole_numbers(spark, path)
    assert [t for _, t in found.dtypes] == ["string"] * 6 + ["bigint"] * 2
    assert rows(found) == [("KR", "Korea, Republic of", "Asia", "NA", "Namibia", "Africa", 4000, None)]


def test_csv_keeps_quotes_blanks_and_line_breaks(spark, tmp_path):
    data = [("a", 'The "Big" land, x', 1), ("b", "  pad ", 2), ("NA", 'say ""', 3), (None, "two\nlines", 4), ("e", None, 5)]
    frame = spark.createDataFrame(data, "code string, label string, n long")
    files.write_csv(frame, str(tmp_path / "out"))
    back = delimited.read_csv(spark, str(tmp_path / "out"), frame.schema, multiLine="true")
    assert rows(back) == rows(frame)
    path = write(tmp_path / "quoted.csv", 'code,label,n\nXX,"The ""Big"" land, x",1\n')
    assert rows(delimited.read_csv(spark, path, frame.schema)) == [("XX", 'The "Big" land, x', 1)]


@pytest.mark.parametrize("text,value", [("3000000000", 3_000_000_000), ("4e3", 4000), ("9223372036854775807", 2**63 - 1), ("-7", -7), ("", None)])
def test_whole_numbers(spark, tmp_path, text, value):
    path = write(tmp_path / "raw.csv", f"YEAR,NB_OF_FLIGHT,DEP_ISO_COUNTRY_CODE,DES_ISO_COUNTRY_CODE\n2014,{text},A,B\n")
    assert rows(delimited.read_raw_flows(spark, path)) == [(2014, value, "A", "B")]


@pytest.mark.parametrize("text", ["x", "4.5", "9223372036854775808"])
def test_what_is_no_whole_number_fails(spark, tmp_path, text):
    path = write(tmp_path / "raw.csv", f"YEAR,NB_OF_FLIGHT,DEP_ISO_COUNTRY_CODE,DES_ISO_COUNTRY_CODE\n2014,{text},A,B\n")
    with pytest.raises(Exception, match="no whole number"):
        delimited.read_raw_flows(spark, path).collect()


def test_gzip_csv_with_inferred_types(spark, tmp_path):
    path = write(
        tmp_path / "pairs.csv.gz", "entry_day,adep,flight\n2020-01-01,NA,3\n2020-01-02,,4\n",
        gzip.open,
    )
    found = delimited.read_csv(spark, path)
    assert dict(found.dtypes) == {"entry_day": "date", "adep": "string", "flight": "int"}
    assert rows(found, "adep", "flight") == [("NA", 3), (None, 4)]


def test_centroids(spark, tmp_path):
    path = write(
        tmp_path / "centroids.csv",
        "Name,ISO_A3,iso a2,Longitude,Latitude,other\nNamibia,NAM,NA,17,-22,x\n",
    )
    found = delimited.read_centroids(spark, path)
    assert found.columns == schemas.CENTROIDS.names
    assert rows(found) == [("Namibia", "NAM", "NA", 17.0, -22.0)]


def test_inline_rows_are_a_local_relation(spark):
    frame = inline_rows(spark, schemas.YEARS, [(2014,), (2015,)])
    assert "LocalTableScan" in frame._jdf.queryExecution().executedPlan().toString()
    assert frame.schema == schemas.YEARS


def test_bound_query_binds_values_not_text(spark):
    frame = spark.createDataFrame([("a'; --",), ("b",)], "name string")
    found = tables.bound_query(
        spark, "SELECT name, :wef AS wef FROM {t} WHERE name = :name", PERIOD,
        {"name": "a'; --"}, t=frame,
    )
    assert rows(found) == [("a'; --", "2020-01-01T00:00:00Z")]


def test_database_read_is_split_over_the_period():
    options = tables.jdbc_options("jdbc:x", "fac_flight", "lobt", PERIOD, 64, user="me")
    assert options["partitionColumn"] == "lobt"
    assert (options["lowerBound"], options["upperBound"]) == (
        "2020-01-01 00:00:00",
        "2020-10-13 00:00:00",
    )
    assert (options["numPartitions"], options["user"]) == ("64", "me")
    by_key = tables.jdbc_options("jdbc:x", "fac_flight", "flt_uid", (0, 10**9), 64)
    assert (by_key["lowerBound"], by_key["upperBound"]) == ("0", "1000000000")


def test_catalog_table_and_folders(spark, tmp_path):
    frame = spark.range(3)
    frame.write.format("orc").save(str(tmp_path / "orc"))
    assert tables.read_files(spark, str(tmp_path / "orc"), frame.schema, "orc").count() == 3
    frame.createOrReplaceTempView("three")
    assert tables.read_table(spark, "three").count() == 3


def test_extract_is_built_once(spark, tmp_path):
    path = extracts.period_path(str(tmp_path / "pairs_{wef}_{til}"), PERIOD)
    assert path.endswith("pairs_2020-01-01_2020-10-13")
    calls = []

    def build(n):
        return lambda: calls.append(n) or spark.range(n)

    assert extracts.read_or_build(spark, path, build(2)).count() == 2
    assert extracts.read_or_build(spark, path, build(3)).count() == 2
    assert extracts.read_or_build(spark, path, build(4), refresh=True).count() == 4
    with pytest.raises(Exception, match="lost"):
        extracts.read_or_build(spark, path, lambda: spark.range(9).select(F.raise_error(F.lit("lost"))), refresh=True)
    assert extracts.read_or_build(spark, path, build(5)).count() == 4
    with pytest.raises(Exception, match="lost"):
        extracts.read_or_build(spark, f"{path}2", lambda: spark.range(9).select(F.raise_error(F.lit("lost"))))
    assert extracts.read_or_build(spark, f"{path}2", build(6)).count() == 6
    assert calls == [2, 4, 6]


def test_days_are_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "daily")
    extracts.write_days(daily(spark), path)
    later = daily(spark).where("entry_day = '2020-01-02'").withColumn("flight", F.lit(100))
    extracts.write_days(later, path)
    found = extracts.read_period(spark, path, Period.of("2020-01-02", "2020-01-03"))
    assert rows(found, "flight") == [(100,), (100,)]
    assert dict(found.dtypes)["entry_day"] == "date"
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "entry_day" in scan.split("PartitionFilters: [")[1].split("]")[0]
    both = extracts.read_period(spark, path, Period.of("2020", "2021"))
    assert rows(both, "flight") == [(100,), (100,), (3,), (4,)]


def test_csv_round_trip(spark, tmp_path):
    frame = inline_rows(
        spark, schemas.COUNTRIES, [("KR", "Korea, Republic of", 0), ("NA", None, 1)]
    )
    path = str(tmp_path / "countries")
    files.write_csv(frame, path, gzip=True)
    assert all(name.endswith(".csv.gz") for name in os.listdir(path) if name.startswith("part"))
    assert rows(delimited.read_csv(spark, path, schemas.COUNTRIES)) == rows(frame)


def test_properties_hold_no_token_unless_given(spark):
    found = dict(rows(files.map_properties(spark, title="Flights", source__name="me")))
    assert found["title"] == "Flights" and found["source.name"] == "me"
    assert found["mapbox.accessToken"] is None
    assert found["msg.totalCount.allTrips"] == "{0} flights"
    assert len(found) == 21
    assert dict(rows(files.map_properties(spark, mapbox__accessToken="t")))[
        "mapbox.accessToken"
    ] == "t"


def daily(spark):
    data = [
        (date(2020, 1, d), a, b, n, f"LAND {c}", c, f"LAND {e}", e)
        for d, a, b, n, c, e in [
            (1, "LFPG", "EDDF", 3, "FR", "DE"),
            (1, "LFPO", "EDDM", 4, "FR", "DE"),
            (2, "EDDF", "LFPG", 5, "DE", "FR"),
            (2, "EDDF", "ZZZZ", 6, "DE", None),
        ]
    ]
    return spark.createDataFrame(
        data,
        "entry_day date, adep string, ades string, flight bigint, adep_country_iso_name string, "
        "adep_country_iso_code string, ades_country_iso_name string, ades_country_iso_code string",
    )


def test_map_files(spark, tmp_path):
    places = inline_rows(
        spark, schemas.CENTROIDS, [("Germany", "DEU", "DE", 9.0, 51.0), ("France", "", "FR", 1.0, 1.0)]
    )
    out = str(tmp_path)
    daily_map.write_map(daily(spark), places, out, by_day=True, title="t")
    flows = delimited.read_csv(spark, f"{out}/flows")
    assert [tuple(map(str, r)) for r in flows.collect()] == [
        ("2", "1", "7", "2020-01-01"),
        ("1", "2", "5", "2020-01-02"),
    ]
    assert delimited.read_csv(spark, f"{out}/locations").columns == ["id", "name", "lat", "lon"]
    days = sorted(n for n in os.listdir(f"{out}/days") if n.startswith("time="))
    assert days == ["time=2020-01-01", "time=2020-01-02"]
    listed = delimited.read_csv(spark, f"{out}/day_list").first()[0]
    assert listed == "2020-01-02,2020-01-01"
    assert delimited.read_csv(spark, f"{out}/properties").count() == 21
    # What the timeline lacks are the flights without a code at one end.
    total = daily(spark).agg(F.sum("flight")).first()[0]
    assert flows.agg(F.sum(F.col("count").cast("int"))).first()[0] == total - 6
    assert rows(daily_map.map_timeline(daily(spark), places), "count") == [(5,), (7,)]


def test_chart_files(spark, tmp_path):
    classification = inline_rows(
        spark,
        schemas.CLASSIFICATION,
        [
            ("FR", "France", "Western Europe", "Home", "West"),
            ("RS", "Serbia", "Southern Europe", "Home", "East"),
            ("RU", "Russia", "Eastern Europe", "Russia", None),
            ("SN", "Senegal", "Western Africa", None, None),
        ],
    )
    raw = country_rows(
        spark,
        [
            ("2014", 3000, "CS", "RU"),
            ("2014", 3000, "RS", "RU"),
            ("2015", 100, "RS", "RU"),
            ("2015", 5000, "SN", "FR"),
            ("2015", 9, "FR", "RS"),
            ("2015", 7, "RU", "RU"),
            ("2015", 5, "FR", None),
        ],
    )
    out = str(tmp_path)
    circular.write_chart(raw, classification, "Home", out, [2014, 2015])

    def read(name):
        return delimited.read_csv(spark, f"{out}/{name}")

    cells = ["origin_iso", "origin_region_name", "destination_iso", "destination_region_name",
             "countryflow_2014", "countryflow_2015"]
    assert rows(delimited.read_whole_numbers(spark, f"{out}/extra-flows"), *cells) == [
        ("RS", "Home", "RU", "Asia", 6000, 0),
        ("SN", "Western Africa", "FR", "Home", 0, 5000),
    ]
    assert rows(delimited.read_whole_numbers(spark, f"{out}/intra-flows"), *cells) == [
        ("FR", "West", "RS", "East", 0, 9)
    ]
    assert [r.iso for r in read("extra_countries").collect()] == ["FR", "RS", "RU", "SN"]
    assert rows(read("intra_countries")) == [("FR", "France", 1), ("RS", "Serbia", 1)]
    assert [r.name for r in read("extra_regions").collect()] == ["Asia", "Home", "Western Africa"]
    assert rows(read("intra_years")) == [(2015,)]
    assert rows(read("extra_years")) == [(2014,), (2015,)]
    assert read("flows").count() == 5
    un = circular.with_un_region(circular.clean_flows(raw), classification)
    assert rows(un.where("origin_iso = 'SN'"), "origin_region_name") == [("Western Africa",)]


def test_from_the_raw_file_to_the_graph(spark, tmp_path):
    path = write(
        tmp_path / "raw.csv",
        "YEAR,NB_OF_FLIGHT,DEP_ISO_COUNTRY_CODE,DES_ISO_COUNTRY_CODE\n"
        "2015,9000,CS,FR\n2015,9000,RS,FR\n2015,14600,FR,RS\n2014,99999,FR,RS\n2015,99999,,FR\n",
    )
    classification = inline_rows(spark, schemas.CLASSIFICATION, [("FR", "France", "a", "b", "c")])
    flows = circular.clean_flows(delimited.read_raw_flows(spark, path))
    assert flows.columns == ["year", "flights", "origin_iso", "destination_iso"]
    prepared = circular.with_home_region(flows, classification)
    files.write_csv(prepared, str(tmp_path / "flows"))
    stored = delimited.read_whole_numbers(spark, str(tmp_path / "flows"))
    assert rows(stored) == rows(prepared)
    nodes, links = od_graph(stored, 2015)
    assert rows(nodes) == [(0, "FRdes"), (1, "RSdep")]
    assert rows(links) == [(1, 0, 18000)]


def test_outputs_have_the_declared_schemas(spark):
    def shape(schema):
        return [(f.name, f.dataType) for f in schema]

    places = inline_rows(spark, schemas.CENTROIDS, [])
    pairs = flowmap.country_pairs(daily(spark))
    located = flowmap.locations(pairs, places)
    prepared = inline_rows(spark, schemas.PREPARED_FLOWS, [])
    star = (flights(spark, []), airports(spark, []), aircraft(spark))
    outputs = [
        (country_flows(*star, "2001", "2002"), schemas.COUNTRY_FLOWS),
        (
            daily_airport_flows(operational(spark, []), star[1], "2001", "2002"),
            schemas.DAILY_AIRPORT_FLOWS,
        ),
        (pairs, schemas.COUNTRY_PAIRS),
        (located, schemas.LOCATIONS),
        (flowmap.flow_timeline(pairs, located), schemas.TIMELINE),
        (lists.visible_countries(prepared, 1), schemas.COUNTRIES),
        (lists.visible_regions(prepared), schemas.REGIONS),
        (lists.visible_years(prepared), schemas.YEARS),
        (files.map_properties(spark), schemas.PROPERTIES),
    ]
    for frame, schema in outputs:
        assert shape(frame.schema) == shape(schema)


def test_yearly_map(spark):
    dim = airports(
        spark,
        [
            {"icao_ap_code": code, "ec_iso_ct_code": "XX", "longitude": lon, "latitude": lat,
             "valid_from": "2000-01-01", "valid_to": "2030-01-01"}
            for code, lon, lat in [("EHAM", 4.764167, 52.30806), ("EGLL", -0.4613889, 51.4775),
                                   ("KJFK", -73.78, 40.64)]
        ],
    )
    legs = [
        (str(i), "2017-01-01", a, b, "A1", "S")
        for i, (a, b) in enumerate([(0, 1), (0, 1), (0, 2), (1, 1), (1, 0)])
    ]
    points, lines = yearly_map.yearly_map(
        flights(spark, legs), dim, aircraft(spark), "2017-01-01", "2017-01-02"
    )
    assert points.count() == 3
    assert rows(lines, "adep", "ades", "n", "total", "ades_longitude") == [
        ("EGLL", "EHAM", 1, 1, 4.764167),
        ("EHAM", "EGLL", 2, 3, -0.4613889),
        ("EHAM", "KJFK", 1, 3, -73.78),
    ]


def test_role_schemas_match_the_files(spark):
    for name in roles._TABLES:
        path = f"/root/testdata/sf0.001/{name}.parquet"
        declared = {f.name: f.dataType for f in roles.table(spark, "/root/testdata/sf0.001", name).schema}
        assert declared == {f.name: f.dataType for f in spark.read.parquet(path).schema}
