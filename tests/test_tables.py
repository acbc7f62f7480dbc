"""Tables that change as one, the incremental extract, and files with bad rows."""

import glob
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odskein.operators.extracts import daily_airport_flows
from odskein.plans import circular, daily_map
from odskein.plans.daily_table import daily_flows, flights_of_days, stretches, touched_days, update_daily_flows
from odskein.schemas import schema_of
from odskein.sinks.day_tables import add_to_days, read_days, replace_days
from odskein.sinks.manifests import commit, current, publish, published
from odskein.sources.quarantine import read_checked
from tests.frames import airports, operational, rows

DAYS = "entry_day date, adep string, ades string, n int"


def day_rows(spark, *data):
    return spark.createDataFrame([(date.fromisoformat(d), a, "X", n) for d, a, n in data], DAYS)


def test_a_package_appears_whole(spark, tmp_path):
    folder = str(tmp_path)
    one, two = spark.range(3), spark.range(5)
    with pytest.raises(ValueError, match="no published table 'a'"):
        published(spark, folder, "a")
    assert publish(spark, folder, {"a": one, "b": one}) == 1
    broken = spark.range(9).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(spark, folder, {"a": two, "b": broken})
    assert [published(spark, folder, name).count() for name in "ab"] == [3, 3]
    assert publish(spark, folder, {"a": two, "b": two, "c": two}) == 2
    assert [published(spark, folder, name).count() for name in "abc"] == [5, 5, 5]
    assert published(spark, folder, "a", number=1).count() == 3
    with pytest.raises(ValueError, match="no commit 7"):
        published(spark, folder, "a", number=7)
    with pytest.raises(RuntimeError, match="meanwhile"):
        commit(spark, folder, {}, after=1)


def test_days_are_replaced_and_added_to(spark, tmp_path):
    folder = str(tmp_path)
    assert read_days(spark, folder, DAYS).collect() == []
    first = day_rows(spark, ("2024-01-01", "A", 1), ("2024-01-02", "A", 2), ("2024-01-03", "A", 3))
    replace_days(first, folder, [date(2024, 1, d) for d in (1, 2, 3)])
    replace_days(day_rows(spark, ("2024-01-02", "B", 5)), folder, [date(2024, 1, 2), date(2024, 1, 3)])
    assert rows(read_days(spark, folder, DAYS), "entry_day", "adep", "n") == [(date(2024, 1, 1), "A", 1), (date(2024, 1, 2), "B", 5)]
    add_to_days(day_rows(spark, ("2024-01-01", "C", 7), ("2024-01-09", "C", 8)), folder)
    assert rows(read_days(spark, folder, DAYS), "adep", "n") == [("A", 1), ("B", 5), ("C", 7), ("C", 8)]
    assert rows(read_days(spark, folder, DAYS, number=1), "n") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError, match="2024-01-05"):
        replace_days(day_rows(spark, ("2024-01-05", "A", 1)), folder, [date(2024, 1, 1)])
    with pytest.raises(Exception, match="no entry_day"):
        add_to_days(first.withColumn("entry_day", F.lit(None).cast("date")), folder)
    assert current(spark, folder)[0] == 3


def test_stretches_of_days():
    d = lambda n: date(2024, 2, n)
    assert stretches([d(28), d(29), date(2024, 3, 1), d(3), d(3)]) == [(d(3), d(4)), (d(28), date(2024, 3, 2))]


def deliveries(n=400, loads=3):
    rng = random.Random(7)
    flights = []
    for i in range(n):
        left = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 20))
        entry = left + timedelta(hours=rng.choice([1, 5, 20, 60]))
        flights.append((str(i), left.isoformat(), entry.isoformat(), rng.choice("ABC"), rng.choice("ABC"), rng.choice(["TE", "XX"])))
    return [[f for i, f in enumerate(flights) if i % loads == k] for k in range(loads)]


@pytest.mark.parametrize("look_back", [timedelta(days=1), None])
def test_three_loads_equal_a_full_rebuild(spark, tmp_path, look_back):
    folder, places = str(tmp_path), airports(spark, [{"cfmu_ap_code": "A", "cfmu_ap_name": "Aah", "valid_to": "2030-01-01"}])
    known = []
    for load in deliveries():
        known += load
        update_daily_flows(folder, operational(spark, known), operational(spark, load), places, look_back=look_back)
    every = operational(spark, known)
    kept = flights_of_days(every, touched_days(every), look_back)
    whole = daily_airport_flows(kept, places, None, None)
    assert rows(daily_flows(spark, folder)) == rows(whole)
    if look_back is None:
        assert rows(whole) == rows(daily_airport_flows(every, places, None, None))
    else:  # a day's flights do not depend on the days counted with it
        for day in (date(2024, 1, 5), date(2024, 1, 9)):
            alone = daily_airport_flows(every, places, str(day), str(day + timedelta(days=1)))
            assert rows(daily_flows(spark, folder, str(day), str(day + timedelta(days=1)))) == rows(alone)
    assert current(spark, folder)[0] == 3
    assert update_daily_flows(folder, every, every.limit(0), places) is None


@pytest.mark.parametrize("unit", ["month", "year"])
def test_wider_units(spark, tmp_path, unit):
    folder, places = str(tmp_path), airports(spark, [])
    every = operational(spark, [f for load in deliveries(200) for f in load] + [("x", "2023-12-31T20:00", "2024-01-01T01:00", "A", "B", "TE")])
    for bound in ("2024-01-10", None):
        known = every if bound is None else every.where(f"flt_lobt < '{bound}'")
        update_daily_flows(folder, known, known, places, look_back=None, unit=unit)
    for period in ((None, None), ("2024-01-05", "2024-01-09"), ("2024-01-20", None), (None, "2024-01-03")):
        whole = daily_airport_flows(every, places, None, None).where(
            f"entry_day >= date '{period[0] or '0001-01-01'}' AND entry_day < date '{period[1] or '9999-01-01'}'"
        )
        assert rows(daily_flows(spark, folder, *period, unit=unit)) == rows(whole)
    assert stretches([date(2023, 11, 1), date(2023, 12, 1), date(2024, 2, 1)], "month") == [
        (date(2023, 11, 1), date(2024, 1, 1)), (date(2024, 2, 1), date(2024, 3, 1))
    ]


def test_only_touched_days_are_written(spark, tmp_path):
    folder, places = str(tmp_path), airports(spark, [])
    base = [("1", "2024-01-01T01:00", "2024-01-01T02:00", "A", "B", "TE"), ("2", "2024-01-05T01:00", "2024-01-05T02:00", "A", "B", "TE")]
    update_daily_flows(folder, operational(spark, base), operational(spark, base), places)
    new = [("3", "2024-01-05T05:00", "2024-01-05T06:00", "A", "B", "TE")]
    update_daily_flows(folder, operational(spark, base + new), operational(spark, new), places)
    loads = glob.glob(f"{folder}/load=*")
    written = sorted(sorted(p.split("entry_part=")[1] for p in glob.glob(f"{load}/entry_part=*")) for load in loads)
    assert written == [["2024-01-01", "2024-01-05"], ["2024-01-05"]]
    assert rows(daily_flows(spark, folder), "flight") == [(1,), (2,)]
    # a flight that was taken back: its row counts as touched
    update_daily_flows(folder, operational(spark, base[:1] + new), operational(spark, base[1:]), places)
    assert rows(daily_flows(spark, folder), "flight") == [(1,), (1,)]


CSV = '''code,name,day,share
1,Aah,2024-01-01,0.5
4e3,"B, of ""x""",2024-01-02,
x7,Cee,2024-01-03,1
,Dee,,
5,Eee,not a day,1
6,Eff
7,Gee,2024-01-01,1,more

8,"open,2024-01-01,1
99999999999,Aitch,2024-01-01,1
9,NA,2024-01-01,half
code,name,day,share
10,last,2024-12-31,2.25'''


def test_rejected_rows_have_file_line_and_reason(spark, tmp_path):
    path = tmp_path / "flows.csv"
    path.write_text(CSV)
    checked = read_checked(spark, str(path), schema_of("code int, name string, day date, share double"), required=("name",))
    assert sorted(map(tuple, checked.rows.collect()), key=str) == sorted(
        [
            (1, "Aah", date(2024, 1, 1), 0.5),
            (4000, 'B, of "x"', date(2024, 1, 2), None),
            (None, "Dee", None, None),
            (10, "last", date(2024, 12, 31), 2.25),
        ],
        key=str,
    )
    found = {r["line"]: r["reason"] for r in checked.rejected.collect()}
    assert found == {
        4: "code holds no whole number of 32 bits: x7",
        6: "day holds no date: not a day",
        7: "not 4 fields",
        8: "not 4 fields",
        9: "empty line",
        10: "a quote is not closed",
        11: "code holds no whole number of 32 bits: 99999999999",
        12: "share holds no double: half",
    }
    texts = CSV.split("\n")
    assert all(r["text"] == texts[r["line"] - 1] and r["file"].endswith("flows.csv") for r in checked.rejected.collect())


def test_lines_are_counted_over_pieces_of_a_file(spark, tmp_path):
    lines = ["n"] + [str(i) if i % 97 else f"bad{i}" for i in range(1, 5001)]
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        checked = read_checked(spark, str(tmp_path), schema_of("n bigint"), required=("n",))
        found = checked.rejected.collect()
        assert len({(r["file"], r["line"]) for r in found}) == len(found) == 2 * (5000 // 97)
        assert all(r["text"] == lines[r["line"] - 1] for r in found)
        assert checked.rows.count() + len(found) == 2 * 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_chart_and_map_packages(spark, tmp_path):
    raw = spark.createDataFrame(
        [("2014", 9000, "FR", "CN"), ("2014", 40, "FR", "DE"), ("2015", 9000, "CN", "FR"), ("2015", 3, "XF", None)],
        "year string, nb_of_flight bigint, dep_iso_country_code string, des_iso_country_code string",
    )
    scheme = spark.createDataFrame(
        [("FR", "France", "Home", "West"), ("DE", "Germany", "Home", "West"), ("CN", "China", "China", "East")],
        "iso2c string, country_name string, home_region string, sub_region string",
    )
    folder = f"{tmp_path}/chart"
    assert circular.publish_chart(raw, scheme, "Home", folder, [2014, 2015]) == 1
    assert rows(published(spark, folder, "intra-flows"), "countryflow_2014", "countryflow_2015") == [(40, 0)]
    assert published(spark, folder, "extra-flows").count() == 2
    assert set(current(spark, folder)[1]) == {"flows", *(f"{s}{t}" for s in ("intra", "extra") for t in ("-flows", "_countries", "_regions", "_years"))}
    daily = spark.createDataFrame(
        [(date(2024, 1, 1), "A", "B", 5, "france", "FR", "china", "CN")],
        "entry_day date, adep string, ades string, flight bigint, adep_country_iso_name string, adep_country_iso_code string, "
        "ades_country_iso_name string, ades_country_iso_code string",
    )
    places = spark.createDataFrame([("France", "FRA", "FR", 2.0, 47.0)], "name string, iso_a3 string, iso_a2 string, longitude double, latitude double")
    assert daily_map.publish_map(daily, places, f"{tmp_path}/map", title="T") == 1
    assert rows(published(spark, f"{tmp_path}/map", "flows"), "origin", "dest", "count", "time") == [(2, 1, 5, "2024-01-01")]
    assert rows(published(spark, f"{tmp_path}/map", "day_list")) == [("2024-01-01",)]
    assert published(spark, f"{tmp_path}/map", "locations").columns == ["id", "name", "lat", "lon"]


def test_decimals_are_exact(spark, tmp_path):
    (tmp_path / "x.csv").write_text("n\n0.1\n1e3\n1.005\n")
    checked = read_checked(spark, str(tmp_path / "x.csv"), StructType.fromDDL("n decimal(10, 3)"))
    assert rows(checked.rows) == [(Decimal("0.100"),), (Decimal("1.005"),), (Decimal("1000.000"),)]
