"""Archives: exact round trip, and salvage of damaged ones."""

import hashlib
import io
import random
import tracemalloc
import zlib

import pytest

from odskein.llm import warc
from odskein.llm.shared import new_path

PAGES = "page_id long, url string, html string"
LONG = "<p>long enough to be worth a revisit</p>" * 4


def pages():
    return [
        (3, "http://a/", LONG),
        (1, "http://b/\r\nInjected: x", LONG),
        (2, None, LONG),
        (1, "http://b/", LONG),
        (4, "http://é/", "short"),
        (5, "u", "short"),
        (6, "u", None),
        (7, "u", ""),
        (8, "u", "ü" * 50),
        (9, "u", "ü" * 50),
        (10, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3),
        (None, "u", LONG),
        (None, "u", "\x1f\x8b\x08 alone " * 20),
        (11, "u", "x" * 3_000_000),
    ]


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        start = first.get(html)
        later = start is not None and (page_id is None or page_id > start)
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if later else "response", start if later else None))
    return out


def test_round_trip(spark):
    rows = pages()
    records = warc.archived(spark.createDataFrame(rows, PAGES).repartition(3)).where("kind = 'record'")
    found = [tuple(r) for r in records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(found, key=repr) == sorted(expected(rows), key=repr)


def test_payloads_come_back_and_files_stay_small(spark):
    rows = [(i, f"u{i}", f"{random.Random(i).random()}" * 300) for i in range(60)]
    folder = f"file://{new_path(spark, 'warc')}"
    manifest = warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), folder, file_bytes=2000)
    assert manifest.count() > 3
    found = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(manifest).collect()}
    assert found == {i: html for i, _, html in rows}


def test_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


# ---------------------------------------------------------------- salvage


def record(i, payload):
    return warc.record_bytes(i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), None, False, "2024-01-01T00:00:00Z")


def salvaged(data):
    found = list(warc.salvage(warc.Archive(io.BytesIO(data), len(data))))
    edges = [(a, b) for a, b, _ in found]
    assert [a for a, _ in edges] == [0, *[b for _, b in edges[:-1]]] and edges[-1][1] == len(data)
    return [f["page_id"] for _, _, f in found if isinstance(f, dict)], [(a, b) for a, b, f in found if isinstance(f, str)]


def archive(packed, count=6):
    payloads = [f"<html>{i}</html>".encode() * (20 + i) for i in range(count)]
    return [warc.member(record(i, p)) if packed else record(i, p) for i, p in enumerate(payloads)]


@pytest.mark.parametrize("packed", [True, False])
def test_sound_archive(packed):
    assert salvaged(b"".join(archive(packed))) == ([0, 1, 2, 3, 4, 5], [])


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "zero", "junk"])
def test_damage_costs_one_record(packed, damage):
    parts = archive(packed)
    bad = bytearray(parts[2])
    middle = len(bad) * 2 // 3
    if damage == "flip":
        bad[middle] ^= 255
    elif damage == "cut":
        del bad[middle:]
    elif damage == "zero":
        bad[:] = bytes(len(bad))
    else:
        bad = bytearray(b"\x1f\x8b\x08 WARC/1.1 no record \r\n" + bytes(bad[middle:]))
    parts[2] = bytes(bad)
    ids, gaps = salvaged(b"".join(parts))
    assert ids == [0, 1, 3, 4, 5]
    begin = len(parts[0]) + len(parts[1])
    assert gaps == [(begin, begin + len(parts[2]))]


@pytest.mark.parametrize("packed", [True, False])
def test_cut_off_end_and_leading_junk(packed):
    data = b"".join(archive(packed))
    ids, gaps = salvaged(b"junk" * 500_000 + data[:-30])
    assert ids == [0, 1, 2, 3, 4] and len(gaps) == 2


def test_one_member_with_a_bad_record():
    parts = archive(False)
    parts[2] = parts[2].replace(b"<html>2", b"<html>X", 1)
    data = warc.member(b"".join(parts))
    ids, gaps = salvaged_inside(data)
    assert ids == [0, 1, 3, 4, 5] and len(gaps) == 1
    begin = len(parts[0]) + len(parts[1])
    assert f"in member at 0, unpacked bytes {begin} to {begin + len(parts[2])}" in gaps[0]


def test_one_member_cut_off_or_damaged_in_its_middle():
    payloads = [random.Random(i).randbytes(3000) for i in range(6)]
    data = warc.member(b"".join(record(i, p) for i, p in enumerate(payloads)))
    middle = len(data) // 2
    for broken in (data[:middle], data[:middle] + bytes(60) + data[middle + 60 :]):
        ids, gaps = salvaged_inside(broken)
        assert ids[:2] == [0, 1] and 2 <= len(ids) < 6 and len(gaps) == 1


def salvaged_inside(data):
    found = [f for *_, f in warc.salvage(warc.Archive(io.BytesIO(data), len(data)))]
    return [f["page_id"] for f in found if isinstance(f, dict)], [f for f in found if isinstance(f, str)]


def test_random_damage_never_crashes_or_forges():
    whole = b"".join(archive(True, 12))
    for seed in range(60):
        rng = random.Random(seed)
        data = bytearray(whole)
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(len(data))
            data[at : at + rng.randint(0, 40)] = rng.randbytes(rng.randint(0, 40))
        ids, _ = salvaged(bytes(data))
        assert ids == sorted(set(ids)) and set(ids) <= set(range(12)) and len(ids) >= 4


def long_headed(i, payload, size):
    """A record with a header line of some size."""
    return record(i, payload).replace(b"Content-Type: application", b"X-Long: " + b"y" * size + b"\r\nContent-Type: application", 1)


@pytest.mark.parametrize("packed", [True, False])
def test_headers_of_any_length(packed):
    parts = [long_headed(i, b"<html>%d</html>" % i, 200_000 * i) for i in range(4)]
    parts = [warc.member(p) if packed else p for p in parts]
    assert salvaged(b"".join(parts)) == ([0, 1, 2, 3], [])
    assert salvaged(b"junk" + b"".join(parts)) == ([0, 1, 2, 3], [(0, 4)])


def test_long_gzip_headers_are_found():
    def named(data, size):
        whole = warc.member(data)
        return whole[:3] + bytes([8]) + whole[4:10] + b"n" * size + b"\0" + whole[10:]

    parts = [named(record(i, b"<html>%d</html>" % i), 20_000 * i) for i in range(4)]
    assert salvaged(b"".join(parts)) == ([0, 1, 2, 3], [])
    assert salvaged(b"junk" + b"".join(parts)) == ([0, 1, 2, 3], [(0, 4)])


@pytest.mark.parametrize("held", [4 << 20, 0])
def test_members_unpacked_twice(monkeypatch, held):
    """A member too large to be kept gives what it would give if it were kept."""
    monkeypatch.setattr(warc.Member, "HELD", held)
    test_one_member_with_a_bad_record()
    test_one_member_cut_off_or_damaged_in_its_middle()
    test_random_damage_never_crashes_or_forges()
    for damage in ("flip", "cut", "zero", "junk"):
        test_damage_costs_one_record(True, damage)


def test_a_large_member_takes_little_memory():
    """An archive of 200 MB compressed as one member."""
    payload = random.Random(1).randbytes(1000) * 1000
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = b"".join(packer.compress(record(i, payload)) for i in range(200)) + packer.flush()
    tracemalloc.start()
    ids = [f["page_id"] for *_, f in warc.salvage(warc.Archive(io.BytesIO(data), len(data)))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids == list(range(200)) and peak < 40 << 20


def test_copies_of_a_hot_page_are_split(spark):
    html = "<html>" + "the one page that a third of the table holds " * 20
    pages = [(i, f"http://x/{i}", html if i % 3 else f"{i} {html}") for i in range(6000)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(8)
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        found = warc.first_pages(frame, 100)
        assert sum(row["later"] for row in found.collect()) == 3999
        assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
