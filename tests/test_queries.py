"""Every registered query against its SQL twin on the driver's tables."""

import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from odskein.shipping import oracle, registry
from tests.compare import duck, plan, spark_rows, sql_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = dict(registry.QUERIES)
# These run a job of their own and read the table it stored.
STORED = {
    "bucketed_country_flows", "checked_rows", "closed_event_days", "followed_event_days", "incremental_daily_flows",
    "published_chart", "published_map",
}
ORACLE = dict(oracle.ORACLE)


@pytest.fixture(scope="module")
def db():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    names, rows = spark_rows(frame)
    expected_names, expected = sql_rows(db, ORACLE[name])
    assert names == expected_names
    assert rows == expected
    assert rows
    # The fact is scanned once, nothing is crossed, and no Python runs in a task.
    shown = plan(frame).split("== Initial Plan ==")[0]
    scans = len(re.findall(r"FileScan .*lineitem\.parquet", shown))
    assert scans == (name not in STORED and "JOIN orders ON o_orderkey = l_orderkey" in ORACLE[name])
    assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown
    assert "Python" not in shown


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_building_the_timeline_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("timeline", "building only")
    QUERIES["flow_timeline"](spark, FOLDER)
    jobs = list(tracker.getJobIdsForGroup("timeline"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


@pytest.mark.parametrize("missing", ["corpus_pipeline", "odskein.llm", "numpy", "zstandard"])
def test_the_rest_stands_without_the_text_part(missing):
    """Without the text part, or a library that only it needs, the other queries are there."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.abspath(contract.__file__)))
    assert done.stdout.split() == [str(len(QUERIES))] * 2, done.stderr
