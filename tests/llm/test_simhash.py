"""Fingerprints, groups and representatives against brute force."""

import random
import re

import pytest
import xxhash

from odskein.llm import components as stars
from odskein.llm import simhash
from odskein.llm.components import components
from tests.llm.samples import odd_rows, prose


def slow_fingerprint(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for shingle in shingles:
        value = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            counts[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def slow_groups(prints, radius):
    """The members of each group of values."""
    group = {p: {p} for p in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= radius and group[a] is not group[b]:
                group[a] |= group[b]
                for member in group[b]:
                    group[member] = group[a]
    return group


def varied():
    rng = random.Random(3)
    rows = odd_rows()
    base = prose(200, 11).split()
    for i in range(40):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = "other"
        rows.append((100 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("tile", [2048, 3])
def test_groups_match_brute_force(docs_of, monkeypatch, tile):
    monkeypatch.setattr(simhash.links, "__defaults__", (256, tile))
    rows = varied()
    prints = [(i, slow_fingerprint(t, 4)) for i, t in rows]
    group = slow_groups({p for _, p in prints}, 4)
    expected = []
    for i, p in prints:
        ids = [j for j, q in prints if q in group[p] and j is not None]
        expected.append((i, f"{p:016x}", min(ids, default=None)))
    found = [tuple(r) for r in simhash.near_duplicates(docs_of(rows)).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_one_representative_for_each_group(docs_of):
    rows = varied()
    group = slow_groups({slow_fingerprint(t, 4) for _, t in rows}, 4)
    expected = {}
    for i, t in rows:
        members = frozenset(group[slow_fingerprint(t, 4)])
        expected[members] = min(expected.get(members, (True, 0)), (i is None, i or 0))
    kept = simhash.representatives(docs_of(rows).withColumnRenamed("lang", "row").withColumnRenamed("source", "fingerprint"))
    assert kept.columns == ["doc_id", "text", "row", "fingerprint", "n_chars"]
    found = [(r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()]
    assert sorted(found) == sorted(expected.values())


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.representatives(docs_of([])).count() == 0


@pytest.mark.parametrize("spare", [1, 2, 3])
def test_masks_miss_no_pair(spare):
    rng = random.Random(spare)
    masks = [m & (1 << 64) - 1 for m in simhash.shard_masks(4, spare)]
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_tree_search():
    rng = random.Random(5)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for value in values:
        tree.add(value)
    for query in values[:40]:
        assert sorted(tree.within(query, 2)) == sorted({v for v in values if (v ^ query).bit_count() <= 2})


def test_components_of_a_chain_a_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(30)]
    star = [(100, 100 + i) for i in range(1, 60)]
    edges = [*chain, *star, (7, 7), (200, 201), (201, 200), (200, 201)]
    random.Random(1).shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(60)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("step, edge", [(stars._large_star, "id AS a, hot AS b"), (stars._small_star, "hot AS a, id AS b")])
def test_a_node_with_many_neighbours_is_split(spark, step, edge):
    """The joins of a round have two shuffles of their own, which AQE can split."""
    hot = {stars._large_star: "0", stars._small_star: "1000000"}[step]
    edges = spark.range(1, 40001, 1, 8).selectExpr("id", f"IF(id % 3 > 0, {hot}, {hot} + id) AS hot").selectExpr(*edge.split(", "))
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        hung = step(edges)
        hung.collect()
        assert "SortMergeJoin(skew=true)" in hung._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
