from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from odskein.operators import graph, ids, lists, matrices
from tests.frames import prepared, rows


def flow(year, flights, origin, destination, region="Home", other="Asia"):
    return (year, flights, origin, region, destination, other)


def test_threshold_is_strict_and_fills_zero(spark):
    flows = prepared(
        spark,
        [
            flow(2014, 3650, "FR", "CN"),
            flow(2015, 3651, "FR", "CN"),
            flow(2014, 9000, "FR", "JP"),
            flow(2014, 3650, "DE", "JP"),
            flow(2013, 9999, "DE", "JP"),
        ],
    )
    with pytest.raises(Exception, match="year is not in the list: 2013"):
        matrices.year_matrix(flows, [2014, 2015], fpd=10).collect()
    with pytest.raises(Exception, match="year is not in the list: 2013"):
        matrices.pair_totals_by_year(flows, [2014, 2015]).collect()
    flows = flows.where("year > 2013")
    wide = matrices.year_matrix(flows, [2014, 2015], fpd=10)
    assert wide.columns == matrices.PAIR_KEYS + ["countryflow_2014", "countryflow_2015"]
    found = rows(
        wide, "origin_iso", "destination_iso", "countryflow_2014", "countryflow_2015"
    )
    assert found == [("FR", "CN", 0, 3651), ("FR", "JP", 9000, 0)]


def test_repeated_rows_are_added_before_the_threshold(spark):
    flows = prepared(spark, [flow(2014, 2000, "RS", "CN"), flow(2014, 2000, "RS", "CN")])
    assert rows(matrices.year_matrix(flows, [2014], fpd=10), "countryflow_2014") == [(4000,)]


@pytest.mark.parametrize("form", [float, Fraction])
def test_limits_are_exact(form):
    """The threshold of k flights a year, given per day, is k itself."""
    for k in range(401):
        assert matrices.yearly_limit(form(Fraction(k, 365))) == k
    assert matrices.yearly_limit("0.2") == 73 == matrices.yearly_limit(Decimal("0.2"))
    assert matrices.yearly_limit(0.1) == Fraction(73, 2) and matrices.yearly_limit(10) == 3650


def test_cells_at_the_threshold_stay_out(spark):
    """One pair for each k with k flights, and thresholds at k: only larger totals are above."""
    flows = prepared(spark, [flow(2014, k, f"O{k}", "D") for k in range(1, 401)]).cache()
    above = [
        [F.count_if(matrices.above_limit("flights", kind, matrices.yearly_limit(k / 365))).alias(f"{kind}{k}") for k in range(1, 401)]
        for kind in ("bigint", "double")
    ]
    for counts in above:
        assert list(flows.agg(*counts).first()) == [400 - k for k in range(1, 401)]
    wide = matrices.year_matrix(flows, [2014], fpd=12 / 365)
    assert wide.agg(F.min("countryflow_2014")).first()[0] == 13
    links = graph.od_graph(flows, 2014, fpd=12 / 365).links
    assert links.agg(F.min("value")).first()[0] == 13


def test_years_may_be_text(spark):
    flows = prepared(spark, [flow(2015, 1, "FR", "CN"), flow(2013, 1, "FR", "CN")])
    wide = matrices.year_matrix(flows, [2013, 2015])
    as_text = flows.withColumn("year", F.col("year").cast("string"))
    assert rows(matrices.year_matrix(as_text, ["2013", "2015"])) == rows(wide)


def test_matrix_rows_conserve_the_kept_flights(spark):
    data = [flow(y, 10 * i + y, f"O{i % 4}", f"D{i % 3}") for i in range(30) for y in (2014, 2015)]
    flows = prepared(spark, data)
    wide = matrices.year_matrix(flows, [2014, 2015])
    total = wide.agg(F.sum(F.col("countryflow_2014") + F.col("countryflow_2015"))).first()[0]
    assert total == sum(row[1] for row in data)


def test_null_names_are_a_key(spark):
    flows = prepared(spark, [(2014, 5, "FR", None, "CN", None), (2014, 6, "FR", None, "CN", None)])
    assert rows(matrices.year_matrix(flows, [2014]), "countryflow_2014") == [(11,)]


def test_pair_totals(spark):
    flows = prepared(
        spark,
        [
            flow(2014, 1, "FR", "CN"),
            flow(2014, 2, "CN", "FR", "Asia", "Home"),
            flow(2015, 4, "CN", "FR", "Asia", "Home"),
            flow(2015, 8, "FR", "XX", "Home", None),
        ],
    )
    found = rows(matrices.pair_totals_by_year(flows, [2014, 2015]))
    assert found == [("Asia-Home", 3, 4), (None, 0, 8)]
    stats = matrices.region_pair_stats(flows).collect()
    assert [(r.year, r.flow_name, r.movements) for r in stats] == [
        (2015, None, 8),
        (2015, "Asia-Home", 4),
        (2014, "Asia-Home", 3),
    ]


def test_od_matrix(spark):
    flows = prepared(
        spark,
        [
            flow(2014, 1, "FR", "CN"),
            flow(2015, 2, "FR", "CN"),
            flow(2014, 4, "FR", "JP"),
            flow(2014, 8, "DE", "JP"),
            flow(2014, 16, "DE", None),
            flow(2014, 32, None, "JP"),
        ],
    )
    found = matrices.od_matrix(flows, ["CN", "JP", "XX"])
    assert found.columns == ["origin_iso", "CN", "JP", "XX", "missing"]
    assert rows(found) == [("DE", 0, 8, 0, 16), ("FR", 3, 4, 0, 0), (None, 0, 32, 0, 0)]
    with pytest.raises(Exception, match="destination_iso is not in the list: CN"):
        matrices.od_matrix(flows, ["JP"]).collect()
    with pytest.raises(ValueError, match="missing"):
        matrices.od_matrix(flows, ["missing"])


def test_visible_lists(spark):
    flows = prepared(
        spark, [flow(2015, 1, "FR", "NA"), flow(2014, 1, "NA", "FR", "Asia", None)]
    )
    countries = lists.visible_countries(flows, show=1).collect()
    assert [tuple(r) for r in countries] == [("FR", "Land FR", 1), ("NA", "Land NA", 1)]
    assert [r.name for r in lists.visible_regions(flows).collect()] == ["Asia", "Home", None]
    assert [r.year for r in lists.visible_years(flows).collect()] == [2014, 2015]


def test_top_contributors(spark):
    matrix = spark.createDataFrame(
        [
            ("Home", "France", "China", 5),
            ("Asia", "China", "France", 3),
            ("Asia", "Japan", "France", 3),
            (None, "Nowhere", "France", 1),
        ],
        "origin_region_name string, origin_name string, destination_name string, n int",
    )
    found = [tuple(r) for r in lists.top_contributors(matrix, "n", "Home", n=2).collect()]
    assert found == [("China", 8), ("Japan", 3)]
    everyone = [tuple(r) for r in lists.top_contributors(matrix, "n", "Home").collect()]
    assert everyone == [("China", 8), ("Japan", 3), (None, 1)]


def test_day_list(spark):
    days = spark.sql(
        "SELECT explode(array(date'2020-01-02', date'2020-01-10', date'2020-01-02')) AS entry_day"
    )
    assert lists.day_list(days).first().value == "2020-01-10,2020-01-02"


def test_graph(spark):
    flows = prepared(
        spark,
        [
            flow(2015, 14600, "FR", "DE"),
            flow(2015, 14601, "DE", "FR"),
            flow(2015, 8000, "ES", "FR"),
            flow(2015, 8000, "ES", "FR"),
            flow(2015, 20000, "FR", "FR"),
            flow(2014, 99999, "IT", "FR"),
            flow(2015, 99999, None, "FR"),
        ],
    )
    nodes, links = graph.od_graph(flows, 2015)
    names = {r.id: r.name for r in nodes.collect()}
    assert [names[i] for i in range(len(names))] == ["DEdep", "ESdep", "FRdep", "FRdes"]
    found = {(names[r.source], names[r.target]): r.value for r in links.collect()}
    assert found == {
        ("DEdep", "FRdes"): 14601,
        ("ESdep", "FRdes"): 16000,
        ("FRdep", "FRdes"): 20000,
    }


@pytest.mark.parametrize("start", [0, 1])
def test_ordered_ids_follow_string_order(spark, start):
    keys = ["", "A", "AB", "ABC", "ABD", "B", "aa", "Zz", "é", "éa", "日本", "日", "##", "ES-CN"]
    frame = spark.createDataFrame([(k, len(k)) for k in keys], "k string, n int")
    found = {r.k: (r.id, r.n) for r in ids.with_ordered_id(frame, "k", start=start).collect()}
    expected = sorted(keys, key=lambda k: k.encode())
    assert found == {k: (i + start, len(k)) for i, k in enumerate(expected)}


def test_ordered_ids_over_many_keys(spark):
    frame = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    found = ids.with_ordered_id(frame, "k").orderBy("k").collect()
    assert [r.id for r in found] == list(range(1, 5001))


def test_ids_keep_a_missing_key_and_follow_byte_order(spark):
    keys = ["b", None, "a", "ab", "abc", "abd", "é", "", "aé"]
    found = ids.with_ordered_id(spark.createDataFrame([(k, 1) for k in keys], "k string, v int"), "k")
    expected = sorted((k for k in keys if k is not None), key=lambda k: k.encode()) + [None]
    assert [r.k for r in found.orderBy("id").collect()] == expected
    assert sorted(r.id for r in found.collect()) == list(range(1, 10))


def test_no_flows_make_empty_tables(spark):
    flows = prepared(spark, [])
    assert matrices.year_matrix(flows, []).columns == matrices.PAIR_KEYS
    assert matrices.year_matrix(flows, [2014]).count() == 0
    assert rows(matrices.pair_totals_by_year(flows, [])) == []
    assert rows(matrices.od_matrix(flows, ["FR"])) == []
    assert rows(lists.visible_countries(flows, show=0)) == []
    assert rows(graph.od_graph(flows, 2015).nodes) == []
    assert lists.day_list(spark.sql("SELECT current_date() AS entry_day WHERE false")).first().value == ""
