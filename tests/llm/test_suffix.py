"""Suffix deduplication against brute force, with many files and buckets."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from odskein.llm import suffix_dedup, suffix_runs
from tests.llm.samples import odd_rows, prose

LEAST = suffix_runs.LEAST


def slow(rows):
    """What goes, by the plain definition."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        key = (doc_id is None, doc_id or 0)
        for p in range(len(data) - LEAST + 1):
            piece = data[p : p + LEAST]
            first[piece] = min(first.get(piece, key), key)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - LEAST + 1):
            if first[data[p : p + LEAST]] < (doc_id is None, doc_id or 0):
                gone[p : p + LEAST] = [True] * LEAST
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def varied():
    rng = random.Random(8)
    passages = [prose(30, 20 + i) for i in range(4)] + ["ab" * 100, "z" * 150]
    rows = odd_rows()
    for i in range(40):
        parts = [prose(rng.randint(1, 20), 50 + i)]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            a = rng.randint(0, 40)
            parts += [passage[a : a + rng.randint(40, 120)], prose(rng.randint(0, 4), 90 + i)]
        rows.append((100 + i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("run_bytes,bucket_bytes", [(1 << 24, 1 << 24), (4000, 9000)])
def test_matches_brute_force(docs_of, run_bytes, bucket_bytes):
    rows = varied()
    found = [tuple(r) for r in suffix_dedup.repeated_bytes(docs_of(rows), run_bytes, bucket_bytes).collect()]
    assert sorted(found, key=repr) == sorted(slow(rows), key=repr)


def test_hashes_decide_nothing(docs_of, monkeypatch):
    """With one hash for all stretches of an anchor, and few hashes for anchors, the bytes still decide."""
    found = suffix_runs.stretches

    def blind(text, ends):
        parts = found(text, ends)
        parts.whole, parts.gram = parts.whole * np.uint64(0), parts.gram & np.uint64(0xFF << 56)
        return parts

    monkeypatch.setattr(suffix_dedup, "stretches", blind)
    monkeypatch.setattr(suffix_dedup, "CROWD", 1 << 20)
    rows = varied()
    for run_bytes, bucket_bytes in ((1 << 24, 1 << 24), (4000, 9000)):
        found_rows = [tuple(r) for r in suffix_dedup.repeated_bytes(docs_of(rows), run_bytes, bucket_bytes).collect()]
        assert sorted(found_rows, key=repr) == sorted(slow(rows), key=repr)


def test_packets_are_sent_for_what_there_is(docs_of, tmp_path):
    """A file sends no empty packet, but for the one that carries it through if it has nothing."""
    rows = [(i, prose(12, i)) for i in range(40)] + [(100, "short")]
    paths = [r["run"] for r in suffix_dedup.write_runs(suffix_dedup._plain(docs_of(rows)), f"file://{tmp_path}", 200).collect()]
    packets = list(suffix_dedup._send_classes(10_000)(iter([pa.RecordBatch.from_pydict({"run": paths})])))
    held = [len(suffix_runs.unpack(b.column("packet")[0].as_py())[0]) for b in packets]
    assert len(paths) > 10 and len(packets) <= sum(held) + len(paths)
    assert {b.column("run")[0].as_py() for b in packets} == set(paths)


def test_small_slices(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_runs, "SLICE", 512)
    rows = varied()
    found = [tuple(r) for r in suffix_dedup.repeated_bytes(docs_of(rows), 20_000, 30_000).collect()]
    assert sorted(found, key=repr) == sorted(slow(rows), key=repr)


def test_texts_without_repeats_keep_all_columns(docs_of):
    rows = varied()
    docs = docs_of(rows).withColumnRenamed("lang", "plain").withColumnRenamed("source", "run")
    kept = suffix_dedup.without_repeats(docs, 4000, 9000)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    found = sorted((repr(r["doc_id"]), len(r["text"].encode()), r["plain"], r["run"]) for r in kept.collect())
    sizes = [(repr(i), n - gone, "en", "src0") for i, n, gone, _, _ in slow(rows)]
    # a cut character goes as a whole, so a text may be a few bytes shorter
    assert [f[0] for f in found] == [s[0] for s in sorted(sizes)]
    assert all(s[1] - 8 <= f[1] <= s[1] for f, s in zip(found, sorted(sizes)))


def surrounded():
    """One 30-byte phrase in many surroundings, some of which are shared by two documents."""
    around = [" ".join(prose(12, 1000 + i).split()) for i in range(800)]
    phrase = "see the footer of every page. "
    texts = [f"{a[:60]} {phrase}{around[i * 7 % 400][:60]}" for i, a in enumerate(around)]
    return [(i * 31 % 1000, text) for i, text in enumerate([*texts, *texts[:150]])]


def test_crowded_anchor_matches_brute_force(docs_of):
    rows = [*surrounded(), *varied()]
    found = [tuple(r) for r in suffix_dedup.repeated_bytes(docs_of(rows), 20_000, 30_000).collect()]
    assert sorted(found, key=repr) == sorted(slow(rows), key=repr)


def test_crowded_anchor_is_spread(docs_of, tmp_path):
    """No exchange gathers the surroundings of a phrase in one bucket."""
    rows = [(1000 + i, f"{prose(25, 2000 + i)[:70]} see the footer of every page. {prose(25, 5000 + i)[:70]}") for i in range(2000)]
    paths = [r["run"] for r in suffix_dedup.write_runs(suffix_dedup._plain(docs_of(rows)), f"file://{tmp_path}", 100_000).collect()]
    buckets = 16

    def dealt(packets, key, other):
        return iter(sorted(packets, key=lambda b: (b.column(key)[0].as_py(), b.column(other)[0].as_py())))

    classes = list(suffix_dedup._send_classes(buckets)(iter([pa.RecordBatch.from_pydict({"run": paths})])))
    sent = Counter()
    for batch in classes:
        grams = np.cumsum(suffix_runs.unpack(batch.column("packet")[0].as_py())[0], dtype=np.uint64)
        sent.update(grams.tolist())
    assert max(sent.values()) <= suffix_dedup.CROWD * len(paths) and len(paths) < 10
    groups = []
    original, suffix_dedup._compare = suffix_dedup._compare, lambda group, earlier: groups.append(len(group))
    try:
        kinds = list(suffix_dedup._join_classes(dealt(classes, "bucket", "run")))
        suffixes = list(suffix_dedup._send_suffixes([], buckets)(dealt(kinds, "run", "bucket")))
        entries = Counter()
        for batch in suffixes:
            if batch.column("bucket")[0].as_py() > 0:
                entries[batch.column("bucket")[0].as_py()] += len(suffix_runs.unpack(batch.column("packet")[0].as_py())[1])
        list(suffix_dedup._merge(1)(dealt(suffixes, "bucket", "run")))
    finally:
        suffix_dedup._compare = original
    assert max(groups, default=0) <= suffix_dedup.CROWD * len(paths)
    assert len(entries) == buckets and max(entries.values()) < 2 * sum(entries.values()) / buckets


def test_empty_table(docs_of):
    assert suffix_dedup.repeated_bytes(docs_of([])).count() == 0
    assert suffix_dedup.without_repeats(docs_of([])).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 7])
def test_merge_of_front_coded_runs(count):
    rng = random.Random(count)
    draw = lambda: bytes(rng.choices(b"ab\0", k=rng.randint(1, LEAST))) if rng.random() < 0.5 else b"a" * rng.randint(30, LEAST - 3) + bytes(rng.choices(b"abc", k=3))
    runs = [sorted({draw() for _ in range(rng.randint(0, 60))}) for _ in range(count)]
    coded = [suffix_runs.Run(*suffix_runs.front_code(r)) for r in runs]
    merged, before = [], None
    for run, at, shared in suffix_runs.merge(coded):
        string = runs[run][at]
        if before is not None:
            end = min(len(string), len(before))
            same = next((i for i in range(end) if string[i] != before[i]), end)
            assert shared == same
        merged.append(string)
        before = string
    assert merged == sorted(s for r in runs for s in r)
