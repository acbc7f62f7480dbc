import pytest
from pyspark.sql import functions as F

from odskein import schemas
from odskein.operators import lists, recode, regions
from odskein.sources.literals import inline_rows
from tests.frames import country_rows, prepared, rows

RAW = [
    ("2001", 5, "CS", "FR"),
    ("2001", 7, "RS", "FR"),
    ("2001", 1, "XF", "CS"),
    ("2001", 2, None, "XF"),
    ("2001", 3, "NA", "FR"),
    ("2001", 4, "FR", None),
    ("2001", 6, None, None),
]


def test_recode_country_is_row_by_row(spark):
    found = rows(country_rows(spark, RAW).transform(recode.recode_country))
    assert ("2001", 5, "RS", "FR") in found and ("2001", 7, "RS", "FR") in found
    assert ("2001", 1, "MQ", "RS") in found
    assert ("2001", 2, None, "MQ") in found
    assert ("2001", 3, "NA", "FR") in found


def test_merge_flows_adds_up_keys_that_met(spark):
    merged = recode.merge_flows(recode.recode_country(country_rows(spark, RAW)), "nb_of_flight")
    found = rows(merged)
    assert ("2001", 12, "RS", "FR") in found
    assert sum(r[1] for r in found) == sum(r[1] for r in RAW)
    assert merged.columns == schemas.COUNTRY_FLOWS.names


def test_missing_codes(spark):
    flows = country_rows(spark, RAW)
    assert rows(lists.missing_code_audit(flows)) == [
        ("FR", None, 4),
        (None, "XF", 2),
        (None, None, 6),
    ]
    assert rows(lists.missing_code_totals(flows)) == [(8, 10)]
    assert rows(lists.drop_missing_codes(flows), "nb_of_flight") == [(1,), (3,), (5,), (7,)]
    assert rows(lists.missing_code_totals(flows.where("false"))) == [(0, 0)]


def test_fix_region_needs_a_known_code(spark):
    flows = prepared(
        spark,
        [
            (2001, 1, "AN", "x", "TW", "y"),
            (2001, 2, "IO", "x", "FR", "y"),
            (2001, 3, None, "x", "SN", "y"),
        ],
    )
    columns = ["flights", "origin_region_name", "destination_region_name"]
    assert rows(recode.fix_region(flows), *columns) == [
        (1, "Caribbean", "Eastern Asia"),
        (2, "Eastern Africa", "y"),
        (3, None, "y"),
    ]
    home = recode.fix_home_region(flows)
    assert rows(home, *columns, "origin_name", "destination_name") == [
        (1, "Southern America", "Eastern Asia", "Antilles", "Land TW"),
        (2, "Eastern Africa", "y", "Land IO", "Land FR"),
        (3, None, "Western Africa", None, "Land SN"),
    ]


def test_collapse_regions(spark):
    flows = prepared(
        spark,
        [
            (2001, 1, "RU", "Russia", "CN", "China"),
            (2001, 2, "BR", "Southern America", "US", "Northern America"),
            (2001, 3, "FR", "Europe", "XX", None),
        ],
    )
    found = rows(
        recode.collapse_regions(flows), "origin_region_name", "destination_region_name"
    )
    assert found == [("America", "America"), ("Asia", "Asia"), ("Europe", None)]


CLASSES = [
    ("FR", "France", "Western Europe", "Home", "West"),
    ("DE", "Germany", "Western Europe", "Home", "Centre"),
    ("NA", "Namibia", "Southern Africa", "Africa", None),
]


def classification(spark, extra=()):
    return inline_rows(spark, schemas.CLASSIFICATION, CLASSES + list(extra))


def test_with_region(spark):
    flows = spark.createDataFrame(
        [(2001, 1, "FR", "NA"), (2001, 2, "XX", "DE"), (2001, 3, None, "FR")],
        "year int, flights bigint, origin_iso string, destination_iso string",
    )
    found = regions.with_region(flows, classification(spark), "home_region")
    assert found.columns == schemas.PREPARED_FLOWS.names
    assert rows(found, "flights", "origin_name", "origin_region_name", "destination_region_name") == [
        (1, "France", "Home", "Africa"),
        (2, None, None, "Home"),
        (3, None, None, "Home"),
    ]
    again = regions.with_region(found, classification(spark), "sub_region")
    assert rows(again, "flights", "origin_region_name") == [(1, "West"), (2, None), (3, None)]


def test_a_code_classified_twice_is_refused(spark):
    flows = prepared(spark, [(2001, 1, "FR", None, "DE", None)])
    twice = classification(spark, [("FR", "France", "a", "b", "c")])
    with pytest.raises(Exception, match="several rows for iso2c FR"):
        regions.with_region(flows, twice, "home_region").collect()


SPLIT = [
    (2001, 1, "FR", "Home", "DE", "Home"),
    (2001, 2, "FR", "Home", "NA", "Africa"),
    (2001, 4, "NA", "Africa", "FR", "Home"),
    (2001, 8, "NA", "Africa", "ZA", "Africa"),
    (2001, 16, "XX", None, "FR", "Home"),
    (2001, 32, "XX", None, "NA", "Africa"),
    (2001, 64, "XX", None, "YY", None),
]


def test_split_is_disjoint_and_conserves_flights(spark):
    flows = prepared(spark, SPLIT)
    parts = regions.split_intra_extra(flows, "Home")
    assert rows(parts.intra, "flights") == [(1,)]
    assert rows(parts.extra, "flights") == [(2,), (4,)]
    assert rows(parts.over, "flights") == [(8,)]
    totals = {r.flow_class: (r.n_rows, r.flights) for r in
              regions.flow_class_totals(flows, "Home").collect()}
    assert totals == {"intra": (1, 1), "extra": (2, 6), "over": (1, 8), "undecided": (3, 112)}


def test_prepare_columns(spark):
    found = recode.prepare_columns(country_rows(spark, RAW))
    assert found.columns == ["year", "flights", "origin_iso", "destination_iso"]
    assert found.agg(F.sum("flights")).first()[0] == 28
