"""Shared lines against a plain count of every line."""

import random

from odskein.llm.line_dedup import dropped_places, line_entries, widespread, without_common_lines
from odskein.llm.shared import stored
from tests.llm.samples import odd_rows, prose


def brute(rows, least_chars, least_docs):
    def key(line):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        return lowered.strip(" \t\n\x0b\x0c\r")

    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(doc_id)
    keeper = {k: max(i for i in ids if i is not None) for k, ids in holders.items() if len(ids) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if keeper.get(key(line), doc_id) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def rows_of(seed):
    rng = random.Random(seed)
    common = [prose(rng.randint(3, 12), 50 + i) for i in range(12)]
    rows = odd_rows()
    for i in range(120):
        lines = [rng.choice(common) if rng.random() < 0.5 else prose(8, 1000 * seed + 10 * i + k) for k in range(rng.randint(0, 9))]
        lines = [rng.choice(["", " ", "\t", "\x0b"]) + (x.upper() if rng.random() < 0.2 and x.isascii() else x) + rng.choice(["", "\r", "  "]) for x in lines]
        rows.append((200 + i // 2 if i % 7 == 0 else 500 + i, "\n".join(lines)))
    return rows


def test_against_brute_force(spark, docs_of):
    for seed, chars, least in ((1, 40, 5), (2, 10, 2), (3, 40, 50)):
        rows = rows_of(seed)
        docs = docs_of(rows).withColumnRenamed("lang", "mark").withColumnRenamed("source", "places")
        found = without_common_lines(docs, chars, least).collect()
        assert sorted(map(tuple, found), key=repr) == brute(rows, chars, least)
    assert brute(rows_of(1), 40, 5) != brute(rows_of(1), 40, 10_000)


def test_length_counts_code_points(docs_of):
    rows = [(i, "é" * n + "\n" + "x" * n) for i in range(6) for n in (39, 40)]
    found = without_common_lines(docs_of(rows)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, 40, 5)
    assert sum(row["n_dropped"] for row in found) == 2 * 5


def test_hot_line_is_split(spark, docs_of):
    """A line that all documents hold is no single task's work in the join that looks it up."""
    rows = [(i, "a line that every document of the table holds, again and again\n" * 3 + prose(20, i)) for i in range(3000)]
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in names if k != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        entries = stored(line_entries(docs_of(rows).repartition(16)), "entries")
        common = stored(widespread(entries), "common")
        lost = dropped_places(entries, common)
        assert lost.count() == 2999
        lost.collect()
        assert "SortMergeJoin(skew=true)" in lost._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for name, value in before.items():
            spark.conf.set(name, value)


def test_empty_table(docs_of):
    assert without_common_lines(docs_of([(1, "x")]).limit(0)).collect() == []
