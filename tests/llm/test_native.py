"""Quality rules and license scan against the SQL twins, on odd rows too; nothing but expressions."""

import duckdb
import pyarrow as pa
import pytest

from odskein.llm import license_scan, quality_rules
from odskein.llm.queries import ORACLE
from tests.compare import canonical, plan, spark_rows
from tests.llm.samples import odd_rows, prose

TEXTS = [
    "Released under the MIT License.\nSee the Apache License; the mit license, GENERAL public license",
    "licensed under cc by nc 4\nno more",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this thing",
    "license mit license license",
    " ".join(["one two three four five six seven eight nine ten"] * 3),
    "word " * 30,
    "a b c d e f g h a b c d e f g h",
    "x\nx\n\nx\n y\n# $ %",
]


def run(sql, rows):
    table = {"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}
    db = duckdb.connect()
    db.register("documents", pa.table({"doc_id": pa.array(table["doc_id"], pa.int64()), "text": pa.array(table["text"], pa.string())}))
    found = db.execute(sql)
    return canonical([c[0] for c in found.description], found.fetchall())


WRAPPED = {
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
    "gpl": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the\n * licence named below",
    "mit": "# Permission is hereby granted, free of charge, to any\n# person obtaining a copy\n# of this software and associated files",
}


CC = "This work is licensed under a Creative Commons Attribution{} 4.0\nInternational License."
CC_ENDS = {"": "cc-by", "-NonCommercial": "cc-by-nc", "-ShareAlike": "cc-by-sa", "-NoDerivatives": "cc-by-nd", "-NonCommercial-ShareAlike": "cc-by-nc-sa", "-NonCommercial-NoDerivatives": "cc-by-nc-nd"}


def wrapped(text, width, sign=""):
    """A text in lines of some words, with a sign in front of each."""
    words = text.split()
    return "\n".join(f"{sign} {' '.join(words[at : at + width])}" for at in range(0, len(words), width))


NOTICED = [
    *WRAPPED.values(),
    *map(CC.format, CC_ENDS),
    *(wrapped(text, 7, "# ") for _, text in license_scan.PARAGRAPHS),
    *(prose(30, 7) + wrapped(" ".join(text.split()[6:-3]), 5, "//") + prose(30, 8) for _, text in license_scan.PARAGRAPHS),
    *(" ".join(prose(2, i) + " " + w for i, w in enumerate(text.split())) for _, text in license_scan.NOTICES),
]

# the twins know documents by doc_id, so each row gets its own here
ROWS = [(i, text) for i, (_, text) in enumerate([*odd_rows(), *enumerate(TEXTS), (0, prose(300, 9) * 2), *enumerate(NOTICED)])]


@pytest.mark.parametrize("rows", [ROWS, []], ids=["odd", "empty"])
def test_quality_rules_match_sql(docs_of, rows):
    frame = quality_rules.judged(docs_of(rows)).drop("failed_rules")
    assert "Python" not in plan(frame) and "Arrow" not in plan(frame)
    names, found = spark_rows(frame)
    assert (names, found) == run(ORACLE["op8_quality_rules"], rows)


@pytest.mark.parametrize("rows", [ROWS, []], ids=["odd", "empty"])
def test_license_scan_matches_sql(docs_of, rows):
    frame = license_scan.scan(docs_of(rows))
    assert "Python" not in plan(frame) and "Arrow" not in plan(frame)
    names, found = spark_rows(frame)
    assert (names, found) == run(ORACLE["op9_license_scan"], rows)


def test_license_labels(docs_of):
    rows = {r["doc_id"]: r for r in license_scan.scan(docs_of(list(enumerate(TEXTS)))).collect()}
    assert rows[0]["base_labels"] == "apache,gpl,mit" and rows[0]["n_base"] == 4
    assert rows[1]["labels"] == "cc-by-nc" and 0.8 <= rows[1]["score"] < 1
    assert rows[2]["labels"] == "mit" and rows[2]["n_base"] == 0
    assert rows[3]["n_base"] == 1 and rows[3]["first_word"] == rows[3]["last_word"] == 1


@pytest.mark.parametrize("around", ["", "lines of other words\n" * 30])
def test_wrapped_notices_are_found_whole(docs_of, around):
    rows = [(i, around + text + "\n" + around) for i, text in enumerate(WRAPPED.values())]
    found = {r["doc_id"]: (r["labels"], r["score"], r["n_base"]) for r in license_scan.scan(docs_of(rows)).collect()}
    assert found == {i: (label, 1.0, 0) for i, label in enumerate(WRAPPED)}


def test_scattered_words_and_restricted_forms(docs_of):
    clean = "You may be told that the old file is not in use this week, except with some luck in the end."
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(docs_of(list(enumerate([*map(CC.format, CC_ENDS), clean])))).collect()}
    assert [found[i] for i in range(6)] == [(label, 1.0) for label in CC_ENDS.values()]
    assert found[6] == ("", 0.0)


def test_repeated_rows_are_judged_one_by_one(docs_of):
    frame = quality_rules.judged(docs_of(odd_rows()))
    assert frame.count() == len(odd_rows())


def test_junk_is_rejected_and_prose_kept(docs_of):
    clean = "The house of the old man is on the hill and it was sold for a good price to the town. "
    clean += "He said that this is not the end of it, as the law is with him and with the people of the place."
    junk = " ".join(f"{w}###" for w in clean.split())
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judged(docs_of([(1, clean), (2, junk), (3, clean.upper())])).collect()}
    assert kept == {1: True, 2: False, 3: False}


def test_paragraphs_are_found_without_their_first_words(docs_of):
    """A notice whose opening sentence was lost is still found by the rest of its paragraph."""
    texts = [wrapped(" ".join(text.split()[7:]), 9, " *") for _, text in license_scan.PARAGRAPHS]
    found = {r["doc_id"]: (r["labels"], r["score"] >= 0.8) for r in license_scan.scan(docs_of(list(enumerate(texts)))).collect()}
    assert found[0] == ("mit", True) and found[1] == ("bsd", True) and found[3] == ("gpl", True)
