"""The sweep over version intervals against counting the versions at every instant."""

import random
from datetime import date, datetime, timedelta

import pytest

from odskein.operators.intervals import empty_versions, version_faults, versions_in_force
from tests.frames import rows

BASE = datetime(2020, 1, 1)


def brute(versions):
    """Stretches of each key with one number of versions, from the instants where it changes."""
    found = []
    low, high = datetime(1, 1, 1), datetime(9999, 12, 31)
    for key in {v[0] for v in versions}:
        held = [(a or low, b or high) for k, a, b in versions if k == key and (a or low) < (b or high)]
        cuts = sorted({x for v in held for x in v})
        stretches = []
        for a, b in zip(cuts, cuts[1:]):
            n = sum(s <= a < e for s, e in held)
            if stretches and stretches[-1][3] == n:
                stretches[-1] = (*stretches[-1][:2], b, n)
            else:
                stretches.append((key, a, b, n))
        found += [(k, None if a == low else a, None if b == high else b, n) for k, a, b, n in stretches]
    return sorted(found, key=repr)


def frame(spark, versions):
    return spark.createDataFrame(versions, "code string, valid_from timestamp_ntz, valid_to timestamp_ntz")


def some(rng, n, keys="abcd"):
    def moment():
        return None if rng.random() < 0.05 else BASE + timedelta(hours=rng.randrange(0, 5000, 12))

    return [(rng.choice([*keys, None]), moment(), moment()) for _ in range(n)]


@pytest.mark.parametrize("span", ["DAY", "MONTH", "YEAR"])
def test_against_brute_force(spark, span):
    days = [BASE + timedelta(days=n) for n in range(5)]
    versions = some(random.Random(1), 150)
    versions += [("touching", days[0], days[1]), ("touching", days[1], None), ("apart", days[0], days[1]), ("apart", days[3], days[4])]
    found = versions_in_force(frame(spark, versions), ["code"], "valid_from", "valid_to", span)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(versions)
    faults = version_faults(frame(spark, versions), ["code"], "valid_from", "valid_to", span)
    assert sorted(map(tuple, faults.collect()), key=repr) == [r for r in brute(versions) if r[3] != 1]
    assert {r[3] for r in brute(versions)} >= {0, 1, 2}


def test_dates_and_several_keys(spark):
    versions = [("a", 1, date(2020, 1, 1), date(2020, 3, 1)), ("a", 1, date(2020, 2, 1), None), ("a", 2, date(2020, 2, 1), None)]
    data = spark.createDataFrame(versions, "code string, part int, valid_from date, valid_to date")
    faults = version_faults(data, ["code", "part"], "valid_from", "valid_to")
    assert rows(faults) == [("a", 1, date(2020, 2, 1), date(2020, 3, 1), 2)]


def test_versions_that_never_hold(spark):
    versions = [("a", BASE, BASE), ("a", BASE, BASE - timedelta(days=1)), ("a", BASE, None)]
    assert empty_versions(frame(spark, versions), "valid_from", "valid_to").count() == 2
    assert versions_in_force(frame(spark, versions[:2]), ["code"], "valid_from", "valid_to").collect() == []


def test_a_hot_key_is_spread_over_its_spans(spark):
    """No window holds more of a key than its spans, or the instants of one span."""
    rng = random.Random(2)
    versions = some(rng, 300, "a") + some(rng, 50)
    found = versions_in_force(frame(spark, versions), ["code"], "valid_from", "valid_to", "DAY")
    shown = found._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in shown.splitlines() if " Window " in line]
    assert windows and all("_span" in line for line in windows)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(versions)
