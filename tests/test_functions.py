from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from odskein.functions import labels, nulls
from odskein.functions.period import Period, parse_instant


def values(spark, expression, data, names):
    return [r[0] for r in spark.createDataFrame(data, names).select(expression).collect()]


def test_unknown_condition_gives_null(spark):
    expression = nulls.if_known(F.col("a") == "x", "yes", F.col("b"))
    data = [("x", "b"), ("y", "b"), (None, "b")]
    assert values(spark, expression, data, "a string, b string") == ["yes", "b", None]


def test_missing_text_when_joining_and_when_pasting(spark):
    data = [("A", "B"), (None, "B"), ("A", None), (None, None)]
    names = "a string, b string"
    joined = values(spark, labels.directed_pair(F.col("a"), F.col("b")), data, names)
    assert joined == ["A>B", ">B", "A>", ">"]
    pasted = values(spark, nulls.paste_text(F.col("a"), F.lit(">"), F.col("b")), data, names)
    assert pasted == ["A>B", "NA>B", "A>NA", "NA>NA"]


def test_undirected_pair_does_not_skip_a_missing_end(spark):
    data = [("B", "A"), ("A", "B"), ("A", "A"), (None, "B"), ("A", None)]
    found = values(
        spark, labels.undirected_pair(F.col("a"), F.col("b")), data, "a string, b string"
    )
    assert found == ["A<->B", "A<->B", "A<->A", "<->", "<->"]


def test_sorted_label(spark):
    data = [("Asia", "Europe"), ("Europe", "Asia"), ("Asia", "Asia"), (None, "Asia")]
    found = values(spark, labels.sorted_label(F.col("a"), F.col("b")), data, "a string, b string")
    assert found == ["Asia-Europe", "Asia-Europe", "Asia-Asia", None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("GUINEA-BISSAU", "Guinea-Bissau"),
        ("COTE D'IVOIRE", "Cote D'ivoire"),
        ("CONGO (DRC)", "Congo (Drc)"),
        ("RÉUNION", "Réunion"),
        ("SAINT KITTS  AND NEVIS", "Saint Kitts  And Nevis"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, text, expected):
    assert values(spark, labels.title_case(F.col("a")), [(text,)], "a string") == [expected]


def test_snake_names(spark):
    assert [labels.snake_name(n) for n in ("ENTRY_DAY", "Entry Day", "entryDay", "iso.a2")] == [
        "entry_day",
        "entry_day",
        "entry_day",
        "iso_a2",
    ]
    frame = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    assert labels.snake_columns(frame).columns == ["a_b", "a_b_2"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2001", datetime(2001, 1, 1)),
        ("2001-06", datetime(2001, 6, 1)),
        ("2017-01-02", datetime(2017, 1, 2)),
        ("2017-01-02T03:04:05Z", datetime(2017, 1, 2, 3, 4, 5)),
        ("2017-01-02T03:04:05+02:00", datetime(2017, 1, 2, 1, 4, 5)),
        (date(2017, 1, 2), datetime(2017, 1, 2)),
    ],
)
def test_parse_instant(text, expected):
    assert parse_instant(text) == expected


@pytest.mark.parametrize("text", ["", "yesterday", "2001-13", "2001-02-30"])
def test_bad_dates_are_refused(text):
    with pytest.raises(ValueError):
        parse_instant(text)


def test_years_leave_out_the_end():
    assert Period.of("2001", "2015").years() == list(range(2001, 2015))
    assert Period.of("2001", "2015-01-02").years()[-1] == 2015


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_period_is_half_open_on_every_time_type(spark, kind):
    days = ["2000-12-30", "2000-12-31", "2001-01-01", "2001-12-31", "2002-01-01"]
    frame = spark.createDataFrame([(d,) for d in days], "d string").select(
        F.col("d"), F.col("d").cast(kind).alias("t")
    )
    period = Period.of("2001", "2002")

    def kept(**look_back):
        return [r.d for r in frame.where(period.holds(frame, "t", **look_back)).collect()]

    assert kept() == days[2:4]
    assert kept(look_back=timedelta(days=1)) == days[1:4]


def test_period_bounds_within_a_day_on_a_date_column(spark):
    frame = spark.sql("SELECT explode(sequence(date'2001-01-01', date'2001-01-04')) AS t")
    period = Period.of("2001-01-01T12:00:00", "2001-01-03T12:00:00")
    kept = [r.t.day for r in frame.where(period.holds(frame, "t")).collect()]
    assert kept == [2, 3]


def test_period_does_not_cast_the_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp_ntz'2001-05-05' AS t").write.parquet(path)
    frame = spark.read.parquet(path)
    kept = frame.where(Period.of("2001", "2002").holds(frame, "t"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,2001-01-01T00:00)" in plan
    assert kept.count() == 1


def test_a_number_is_no_time_column(spark):
    with pytest.raises(TypeError):
        Period.of("2001", "2002").holds(spark.range(1), "id")
