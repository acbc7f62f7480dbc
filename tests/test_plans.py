"""What the plans must look like for large tables, and hot keys against brute force."""

import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from odskein.functions.period import Period
from odskein.operators.extracts import civil_flights, count_countries, country_flows, daily_airport_flows
from odskein.operators.flowmap import country_pairs
from odskein.operators.ids import with_ordered_id
from odskein.operators.versions import latest_version
from odskein.operators.yearly import departure_share
from odskein.shipping import roles
from odskein.shipping.oracle import ORACLE
from odskein.shipping.registry import QUERIES
from odskein.sources.bucketed import write_star
from tests.compare import duck, final_plan, plan, spark_rows, sql_rows
from tests.frames import aircraft, airports, flights, operational, rows

FOLDER = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **conf):
    names = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_filters_and_columns_reach_the_scan(spark):
    with settings(spark, spark__sql__maxMetadataStringLength="1000"):
        shown = plan(QUERIES["airport_flows_year"](spark, FOLDER))
    orders = next(line for line in shown.splitlines() if "orders.parquet" in line)
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in orders
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in orders
    assert orders.rstrip().endswith("bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>")
    lines = next(line for line in shown.splitlines() if "lineitem.parquet" in line)
    assert "Not(EqualTo(l_returnflag,R))" in lines
    assert lines.count(":bigint") == 3 and lines.count(":string") == 1


def test_no_broadcast_is_forced(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for name in ("country_flows", "daily_airport_flows", "with_region", "od_links"):
            shown = plan(QUERIES[name](spark, FOLDER))
            assert "BroadcastHashJoin" not in shown and "SortMergeJoin" in shown


@pytest.mark.parametrize(
    "name",
    ["airport_flows_instant", "daily_airport_flows_period", "departure_share", "flow_timeline",
     "intra_year_matrix", "latest_version", "locations", "od_links", "pair_points"],
)
def test_results_do_not_depend_on_broadcasting(spark, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = spark_rows(QUERIES[name](spark, FOLDER))
    assert found == sql_rows(duck(FOLDER), ORACLE[name])


def hot(rng, usual, hot_value):
    """A third of the draws are the hot value."""
    return hot_value if rng.random() < 1 / 3 else rng.choice(usual)


def test_country_flows_with_hot_airports(spark):
    rng = random.Random(1)
    data = [
        (str(i), f"200{rng.randrange(3)}-06-01", hot(rng, range(40), 0), hot(rng, range(40), 1),
         rng.choice(["A1", "H1"]), rng.choice("SM"))
        for i in range(4000)
    ]
    places = [{"ec_iso_ct_code": f"C{i % 7}", "iso_ct_code": f"D{i}"} for i in range(40)]
    expected = Counter(
        (lobt[:4], f"C{a % 7}", f"C{b % 7}")
        for _, lobt, a, b, kind, use in data
        if kind == "A1" and use == "S" and lobt < "2002"
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = country_flows(
            flights(spark, data), airports(spark, places), aircraft(spark), "2000", "2002"
        ).collect()
    assert {
        (r.year, r.dep_iso_country_code, r.des_iso_country_code): r.nb_of_flight for r in found
    } == expected


def test_daily_flows_with_a_hot_day_and_airport(spark):
    rng = random.Random(2)
    data = []
    for i in range(3000):
        day = hot(rng, range(1, 29), 5)
        data.append(
            (str(i), f"2001-01-{day:02}T00:00:00", f"2001-01-{day:02}T12:00:00",
             hot(rng, "ABCDEFG", "A"), hot(rng, "ABCDEFG", "B"), "TE")
        )
    expected = Counter((entry[:10], a, b) for _, _, entry, a, b, _ in data)
    found = daily_airport_flows(
        operational(spark, data), airports(spark, []), "2001-01-01", "2001-02-01"
    )
    counted = {(str(r.entry_day), r.adep, r.ades): r.flight for r in found.collect()}
    assert counted == expected


def test_latest_version_with_a_hot_key(spark):
    rng = random.Random(3)
    data = [(hot(rng, "abcdefgh", "a"), rng.randrange(50), i) for i in range(3000)]
    newest = {}
    for key, version, _ in data:
        newest[key] = max(version, newest.get(key, version))
    expected = sorted((k, v, i) for k, v, i in data if newest[k] == v)
    frame = spark.createDataFrame(data, "k string, v int, i int")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = latest_version(frame, "k", "v")
        assert sorted(tuple(r) for r in found.collect()) == expected
    assert "Window" not in plan(found)


def test_departure_totals_with_a_hot_airport(spark):
    rng = random.Random(4)
    data = [(hot(rng, "ABCDE", "A"), rng.choice("ABCDE"), i) for i in range(2000)]
    totals = Counter()
    for a, b, n in data:
        if a != b:
            totals[a] += n
    frame = spark.createDataFrame(data, "adep string, ades string, nb_of_flight int")
    found = departure_share(frame)
    assert {(r.adep, r.total) for r in found.collect()} == set(totals.items())
    assert found.count() == sum(a != b for a, b, _ in data)
    assert "Window" not in plan(found)


def test_hot_keys_are_split_when_both_sides_are_large(spark):
    small = dict(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__shuffle__partitions="16",
    )
    with settings(spark, **small):
        data = spark.range(0, 60000, 1, 8).select(
            F.col("id").cast("string").alias("flt_uid"),
            F.lit("2001-05-05").cast("timestamp").alias("lobt"),
            (F.col("id") % 50).alias("sk_adep_id"),
            (F.col("id") % 50).alias("sk_ades_id"),
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000)
            .cast("string").alias("aircraft_type_icao_id"),
            F.lit("S").alias("icao_flt_type"),
        )
        types = spark.range(1000).select(
            F.col("id").cast("string").alias("icao_type_code"), F.lit("L2J").alias("icao_desc")
        )
        places = airports(spark, [{"ec_iso_ct_code": f"C{i % 5}"} for i in range(50)])
        found = country_flows(data, places, types, "2001", "2002")
        shown = final_plan(found)
        assert "SortMergeJoin(skew=true)" in shown
        assert sum(r.nb_of_flight for r in found.collect()) == 60000


SPLIT_SOON = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    spark__sql__shuffle__partitions="16",
)


def test_rows_of_a_hot_airport_are_split_from_their_total(spark):
    """The total is an aggregate on the join's own key; still the join has two shuffles of its own."""
    with settings(spark, **SPLIT_SOON):
        adep = F.when(F.col("id") % 3 > 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
        data = spark.range(0, 60000, 1, 8).select(
            adep.alias("adep"), F.lit("B").alias("ades"), F.col("id").alias("nb_of_flight")
        )
        found = departure_share(data)
        assert "SortMergeJoin(skew=true)" in final_plan(found)
        totals = {r.adep: r.total for r in found.collect()}
        assert totals["HOT"] == sum(i for i in range(60000) if i % 3 > 0) and totals["3"] == 3
        assert found.count() == 60000


def test_rows_of_a_hot_version_are_split(spark):
    with settings(spark, **SPLIT_SOON):
        key = F.when(F.col("id") % 3 > 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
        data = spark.range(0, 60000, 1, 8).select(key.alias("k"), F.lit(1).alias("v"), "id")
        found = latest_version(data, "k", "v")
        assert "SortMergeJoin(skew=true)" in final_plan(found)
        assert found.count() == 60000


def test_a_bucketed_star_meets_without_a_shuffle(spark, tmp_path):
    """No exchange below the first join, and the rows are those of the plain extract."""
    rng = random.Random(6)
    data = [
        (str(i), f"200{rng.randrange(2)}-06-01", rng.randrange(40), rng.randrange(40), "A1", "S")
        for i in range(500)
    ]
    places = airports(spark, [{"ec_iso_ct_code": f"C{i % 7}", "iso_ct_code": f"D{i}"} for i in range(40)])
    star = flights(spark, data), places, aircraft(spark)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        civil = civil_flights(star[0], star[2], Period.of("2000", "2002"))
        stored = write_star(spark, civil, places, "star_of_test", str(tmp_path), 4)
        found = count_countries(stored.flights, stored.airports)
        shown = plan(found).splitlines()
        assert rows(found) == rows(country_flows(*star, "2000", "2002"))
    joins = [i for i, line in enumerate(shown) if "SortMergeJoin" in line]
    inner = shown[joins[-1] :]
    assert len(joins) == 2 and "[sk_adep_id" in inner[0] and not any("Exchange" in line for line in inner)


def test_ids_sort_only_bounded_rows_in_one_task(spark):
    key = F.concat(F.lit("A_LONG_PREFIX_THAT_ALL_SHARE_"), F.col("id").cast("string"))
    frame = spark.range(200_000).select(key.alias("k"))
    numbered = with_ordered_id(frame, "k")
    shown = final_plan(numbered)
    # Windows run over counts by prefix and chunk, partitioned by prefix.
    assert "SinglePartition" not in shown
    assert all("[prefix" in line for line in shown.splitlines() if " Window " in line)
    keys = [f"A_LONG_PREFIX_THAT_ALL_SHARE_{i}".encode() for i in range(200_000)]
    siblings = {}
    for code in keys:
        for at in range(0, len(code) + 1, 2):
            siblings.setdefault(code[:at], set()).add(code[at : at + 2])
    assert max(map(len, siblings.values())) <= 65_793
    found = [r.k for r in numbered.orderBy("id").collect()]
    assert found == sorted(code.decode() for code in keys)


def test_country_pairs_hash_the_flights(spark):
    shown = plan(country_pairs(roles_daily(spark)))
    first = [line for line in shown.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in first and "partial_sum(flight" in first


def roles_daily(spark):
    return spark.createDataFrame(
        [],
        "entry_day date, adep string, ades string, flight bigint, adep_country_iso_name string, "
        "adep_country_iso_code string, ades_country_iso_name string, ades_country_iso_code string",
    )


def test_home_is_a_region_of_the_tables(spark):
    assert roles.HOME in {r.r_name for r in roles.nations(spark, FOLDER).collect()}
    assert rows(roles.centroids(spark, FOLDER), "iso_a2")[0] == ("C00",)
