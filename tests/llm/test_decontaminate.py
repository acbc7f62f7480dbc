"""Decontamination against brute force."""

import hashlib
import re

import pytest

from odskein.llm import decontaminate
from tests.llm.samples import SHARED, odd_rows, prose


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(docs, items, width=10):
    windows = set()
    for item, text in items:
        found = words(text)
        if found:
            n = min(width, len(found))
            windows |= {("" if item is None else str(item), tuple(found[i : i + n])) for i in range(len(found) - n + 1)}
    out = []
    for doc_id, text in docs:
        found, hit, named = words(text), set(), set()
        for item, window in windows:
            n = len(window)
            for i in range(len(found) - n + 1):
                if tuple(found[i : i + n]) == window:
                    hit |= set(range(i, i + n))
                    named.add(item)
        listed = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(found), len(hit), len(named), listed, bool(hit)))
    return out


ITEMS = [
    (1, SHARED),
    (2, SHARED[: len(SHARED) // 2]),
    (10, "The MIT License"),
    (11, "mit"),
    (12, "a" * 400),
    (13, ""),
    (14, None),
    (15, " ".join(["on"] * 14)),
    (None, prose(14, 5)),
    (1, prose(11, 3)),
    (1, SHARED),
]
DOCS = [*odd_rows(), (50, " ".join(["on"] * 30)), (51, f"{prose(9, 3)} x {prose(14, 5)}"), (52, "mit-license. MIT")]


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_matches_brute_force(docs_of, items):
    found = [tuple(r) for r in decontaminate.contamination(docs_of(DOCS), items).collect()]
    assert sorted(found, key=repr) == sorted(slow(DOCS, ITEMS), key=repr)


def test_clean_documents_stay_with_all_columns(docs_of, items):
    docs = docs_of(DOCS).withColumnRenamed("lang", "row").withColumnRenamed("source", "places")
    kept = decontaminate.without_contamination(docs, items)
    assert kept.columns == docs.columns
    clean = [r[0] for r in slow(DOCS, ITEMS) if not r[-1]]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_empty_tables(spark, docs_of, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs_of([]), items).count() == 0
    rows = decontaminate.contamination(docs_of(DOCS), none).collect()
    assert len(rows) == len(DOCS) and not any(r["contaminated"] for r in rows)
