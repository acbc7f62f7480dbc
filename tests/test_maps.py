import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from odskein import schemas
from odskein.functions.labels import sorted_label
from odskein.operators import flowmap, lists, tiles, yearly
from odskein.sources.literals import inline_rows
from tests.frames import rows

DAY = date(2020, 1, 1)


def daily(spark, data):
    """Rows of (day, adep, ades, flights, from name and code, to name and code)."""
    return spark.createDataFrame(
        data,
        "entry_day date, adep string, ades string, flight bigint, adep_country_iso_name string, "
        "adep_country_iso_code string, ades_country_iso_name string, ades_country_iso_code string",
    )


def test_misplaced_airport(spark):
    frame = daily(
        spark,
        [
            (DAY, "KVPC", "LFPG", 1, "x", "XX", "y", "FR"),
            (DAY, "LFPG", "KVPC", 2, "y", "FR", "x", None),
            (DAY, None, "LFPG", 4, "y", "ZZ", "y", "FR"),
        ],
    )
    found = rows(
        flowmap.repair_country(frame), "flight", "adep_country_iso_code", "ades_country_iso_code"
    )
    assert found == [(1, "US", "FR"), (2, "FR", "US"), (4, None, "FR")]


def test_country_pairs_keep_namibia_apart_from_missing(spark):
    frame = daily(
        spark,
        [
            (DAY, "A", "B", 1, "NAMIBIA", "NA", "FRANCE", "FR"),
            (DAY, "C", "B", 2, None, None, "FRANCE", "FR"),
            (DAY, "D", "E", 4, "NAMIBIA", "NA", "FRANCE", "FR"),
            (date(2020, 1, 2), "D", "E", 8, "NAMIBIA", "NA", "FRANCE", "FR"),
        ],
    )
    found = rows(
        flowmap.country_pairs(frame),
        "airport_country_pair",
        "count",
        "source",
        "target",
        "source_iso2c",
        "target_iso2c",
    )
    assert found == [
        ("NA>FR", 2, None, "France", None, "FR"),
        ("NA>FR", 5, "Namibia", "France", "NA", "FR"),
        ("NA>FR", 8, "Namibia", "France", "NA", "FR"),
    ]


def test_one_code_under_several_names_is_one_pair(spark):
    frame = daily(
        spark,
        [
            (DAY, "A", "B", 1, "GUINEA-BISSAU", "GW", "COTE D'IVOIRE", "CI"),
            (DAY, "C", "D", 2, "GUINEA BISSAU", "GW", None, "CI"),
        ],
    )
    found = rows(flowmap.country_pairs(frame), "count", "source", "target")
    assert found == [(3, "Guinea Bissau", "Cote D'ivoire")]


def centroids(spark, data):
    return inline_rows(spark, schemas.CENTROIDS, data)


def pairs(spark, data):
    return spark.createDataFrame(
        data, "entry_day date, count bigint, source_iso2c string, target_iso2c string"
    )


BASE = [
    ("France", "FRA", "FR", 2.0, 46.0),
    ("Germany", "DEU", "DE", 9.0, 51.0),
    ("Namibia", "NAM", "NA", 17.0, -22.0),
    ("Guyane", "GUF", "GF", 1.0, 1.0),
    ("Wrong place", None, "YT", 0.0, 0.0),
]


def test_locations(spark):
    frame = pairs(
        spark,
        [
            (DAY, 1, "FR", "NA"),
            (DAY, 1, "GF", "XX"),
            (DAY, 1, "XF", None),
            (DAY, 1, "ES-CN", "##"),
            (DAY, 1, "YT", "DE"),
        ],
    )
    found = rows(flowmap.locations(frame, centroids(spark, BASE)))
    assert found == [
        (1, "UNKNOWN", "##", 0.0, 0.0),
        (2, "Germany", "DE", 51.0, 9.0),
        (3, None, "ES-CN", 28.4398708, -16.9743268),
        (4, "France", "FR", 47.5, 3.2),
        (5, "French Guiana", "GF", 4.100192, -53.165735),
        (6, "Namibia", "NA", -22.0, 17.0),
        (7, "French Antilles", "XF", 14.6345865, -61.2939723),
        (8, None, "XX", None, None),
        (9, "Mayotte", "YT", -12.843056, 45.138333),
    ]


def test_a_place_with_two_centroids_is_refused(spark):
    frame = pairs(spark, [(DAY, 1, "FR", "DE")])
    twice = centroids(spark, BASE + [("France again", None, "FR", 0.0, 0.0)])
    with pytest.raises(Exception, match="several rows for iso_a2 FR"):
        flowmap.locations(frame, twice).collect()


def test_extra_places_are_matched_by_name_not_position(spark):
    swapped = spark.createDataFrame(
        [("Far", 1.5, "ZZ", 2.5)], "name string, latitude double, iso_a2 string, longitude double"
    )
    found = flowmap.all_centroids(centroids(spark, BASE), swapped).where("iso_a2 = 'ZZ'").first()
    assert (found.latitude, found.longitude, found.iso_a3) == (1.5, 2.5, None)


def test_timeline(spark):
    frame = pairs(
        spark,
        [
            (date(2020, 1, 2), 3, "FR", "DE"),
            (DAY, 1, "FR", "DE"),
            (DAY, 0, "DE", "FR"),
            (DAY, 9, "FR", None),
            (DAY, 9, "FR", "FR"),
        ],
    )
    places = flowmap.locations(frame, centroids(spark, BASE))
    found = flowmap.flow_timeline(frame, places)
    assert found.columns == schemas.TIMELINE.names
    assert [tuple(r) for r in found.collect()] == [
        (2, 1, 1, "2020-01-01"),
        (2, 2, 9, "2020-01-01"),
        (2, 1, 3, "2020-01-02"),
    ]
    assert rows(flowmap.flow_timeline(frame, places, threshold=2), "count") == [(3,), (9,)]


def test_departure_share_leaves_out_circular_flights(spark):
    flows = spark.createDataFrame(
        [
            ("2017", 5, "A", "B"),
            ("2017", 2, "A", "C"),
            ("2017", 9, "A", "A"),
            ("2017", 1, "B", "A"),
            ("2017", 7, None, "A"),
        ],
        "year string, nb_of_flight bigint, adep string, ades string",
    )
    found = rows(yearly.departure_share(flows))
    assert found == [("2017", 1, "B", "A", 1), ("2017", 2, "A", "C", 7), ("2017", 5, "A", "B", 7)]
    assert dict(yearly.departure_share(flows).dtypes)["n"] == "bigint"


def test_points_and_pairs(spark):
    airports = spark.createDataFrame(
        [("A", 4.76, 52.3), ("B", -25.0, 29.0), ("C", -25.1, 40.0), ("D", None, 40.0),
         ("E", 1.0, None)],
        "icao string, longitude double, latitude double",
    )
    assert rows(yearly.airport_points(airports), "icao") == [("A",), ("B",), ("C",)]
    assert rows(yearly.airport_points(airports, yearly.EUROPE), "icao") == [("A",), ("B",)]
    lines = spark.createDataFrame([("A", "B", 3), ("B", "Z", 4)], "adep string, ades string, n int")
    assert rows(yearly.pair_points(lines, airports)) == [("A", "B", 3, 4.76, 52.3, -25.0, 29.0)]


def test_region_countries(spark):
    countries = spark.createDataFrame(
        [("France", "Europe"), ("Russia", "Europe"), ("China", "Asia"), (None, "Europe")],
        "name string, region string",
    )
    assert rows(yearly.region_countries(countries), "name") == [("France",)]


def clipped(x0, y0, x1, y1, box):
    """The part of a line inside the box, by trying every crossing."""
    cuts = {0.0, 1.0}
    for a, b, low, high in ((x0, x1, box.west, box.east), (y0, y1, box.south, box.north)):
        if a != b:
            cuts |= {t for t in ((low - a) / (b - a), (high - a) / (b - a)) if 0 <= t <= 1}
    near = 1e-9

    def inside(t):
        x, y = x0 + t * (x1 - x0), y0 + t * (y1 - y0)
        return box.west - near <= x <= box.east + near and box.south - near <= y <= box.north + near

    held = [t for t in cuts if inside(t)]
    return (min(held), max(held)) if held else None


def test_lines_are_clipped_at_the_box(spark):
    rng = random.Random(3)
    box = yearly.EUROPE
    ends = [tuple(rng.uniform(-60, 100) for _ in range(4)) for _ in range(400)]
    ends += [(0, 50, 10, 50), (0, 0, 0, 90), (0, 10, 40, 10), (-25, 29, 45, 75), (-60, 40, -25, 40), (5, 40, 5, 40), (90, 40, 90, 40), (-25, 20, -25, 80)]
    columns = "n int, adep_longitude double, adep_latitude double, ades_longitude double, ades_latitude double"
    data = [(n, *map(float, line)) for n, line in enumerate(ends)] + [(-1, None, 40.0, 5.0, 40.0)]
    found = {r[0]: tuple(r)[1:] for r in yearly.clip_lines(spark.createDataFrame(data, columns), box).collect()}
    for n, (x0, y0, x1, y1) in enumerate(ends):
        part = clipped(x0, y0, x1, y1, box)
        assert (part is None) == (n not in found)
        if part:
            wanted = [c + t * (d - c) for t in part for c, d in ((x0, x1), (y0, y1))]
            assert found[n] == pytest.approx(wanted)
    assert found[400] == (0, 50, 10, 50) and -1 not in found


def test_tiles_and_cells_are_inverse(spark):
    rng = random.Random(5)
    codes = [f"P{i}" for i in range(30)] + [None]
    data = [(rng.choice(codes), rng.choice(codes), rng.randint(1, 9)) for _ in range(500)]
    flows = spark.createDataFrame(data, "origin_iso string, destination_iso string, flights bigint")
    totals, leaving, arriving = Counter(), Counter(), Counter()
    for a, b, n in data:
        totals[a, b] += n
        leaving[a] += n
        arriving[b] += n
    for side in (1, 7, 512):
        matrix = tiles.od_tiles(flows, side=side)
        assert {(r[0], r[1]): r[2] for r in tiles.od_cells(matrix).collect()} == totals
        assert {r[0]: (r[1], r[2]) for r in tiles.tile_totals(matrix).collect()} == {c: (leaving[c], arriving[c]) for c in codes}
        for row in matrix.tiles.collect():
            places = [(c["row"], c["column"]) for c in row["cells"]]
            assert places == sorted(set(places)) and all(0 <= x < side for p in places for x in p)
    assert tiles.od_tiles(flows.limit(0)).tiles.collect() == []


def test_names_in_collated_order(spark):
    names = ["Zypern", "Österreich", "oman", "Åland", "Albanien", "Ägypten", None, "Oman"]
    flows = spark.createDataFrame([("a", n, "a", n) for n in names], "origin_iso string, origin_region_name string, destination_iso string, destination_region_name string")
    plain = [r[0] for r in lists.visible_regions(flows).collect()]
    assert plain == ["Albanien", "Oman", "Zypern", "oman", "Ägypten", "Åland", "Österreich", None]
    ordered = [r[0] for r in lists.visible_regions(flows, "UNICODE").collect()]
    assert ordered == ["Ägypten", "Åland", "Albanien", "oman", "Oman", "Österreich", "Zypern", None]
    by_name = lists.visible_countries(flows.withColumns({"origin_name": F.col("origin_region_name"), "destination_name": F.col("origin_region_name")}), 0, "UNICODE")
    assert [r["name"] for r in by_name.collect()] == ordered
    pairs = spark.createDataFrame([("Zypern", "Österreich"), ("Österreich", "Zypern"), ("Oman", "oman"), ("oman", "Oman"), (None, "Oman")], "a string, b string")

    def labels(collation):
        return [r[0] for r in pairs.select(sorted_label(F.col("a"), F.col("b"), collation)).collect()]

    assert labels(None) == ["Zypern-Österreich"] * 2 + ["Oman-oman"] * 2 + [None]
    assert labels("UNICODE") == ["Österreich-Zypern"] * 2 + ["oman-Oman"] * 2 + [None]
    assert labels("UNICODE_CI") == ["Österreich-Zypern"] * 2 + ["Oman-oman"] * 2 + [None]
