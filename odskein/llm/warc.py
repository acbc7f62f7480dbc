"""WARC archives: write pages as records, and salvage records from (damaged) archives.

Archives are files of records, each record a gzip member of its own (plain archives are read too).
Tasks write them to the shared folder and report them in a manifest; a file that a lost task left
behind is in no manifest and is never read. A file is closed once it holds ``file_bytes``.

The reader goes from record to record. A record must begin with a version line, end where its
length says, pass the member's checksum and match its digests. Where one fails, the reader
searches for the next gzip header whose data begins with a version line (plain: for the next
version line whose record passes), goes on there, and reports the bytes between as a gap. Inside a
member with several records it goes on at the next version line whose record passes; the gap's reason
gives the member's offset and the inner range. Of a member that does not unpack to its end, records
before the damage are kept if their block digest vouches for them. Headers may have any length, and a
member is unpacked piece by piece, so a task holds one record at a time and not a whole archive.

Defined results: a null payload is an empty one; a null url is an empty one; a null page_id sorts
last when the first of equal payloads is chosen; rows that share that smallest page_id are all
responses; repeated rows are all written; line breaks in urls are percent-encoded; an empty table
gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.llm.shared import new_path, stored
from odskein.operators.lookups import with_totals

VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
GZIP = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK = 1 << 20
MANIFEST = "path string, records long, bytes long"
RECORD = (
    "archive string, kind string, begin long, finish long, reason string, page_id long, url string, "
    "record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


# ---------------------------------------------------------------- records


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(page_id, url: str, payload: bytes, digest: str, refers_to, is_revisit: bool, date: str) -> bytes:
    """One record. A revisit keeps the payload's length and digest in its headers, not its bytes."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if is_revisit:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-Id", str(refers_to))]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers).encode("utf-8", "replace")
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """``data`` as one gzip member, the same bytes at every run."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(ValueError):
    """A record that fails a check."""


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """Headers (lower-case names), block and length of the record that starts at ``at``."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, at):
        raise Damaged("no version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise Damaged("headers do not end")
    headers = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    begin = head_end + 4
    end = begin + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    return headers, data[begin:end], end + 4 - at


def checked(headers: dict, block: bytes) -> dict:
    """The record's fields, once its digests match."""
    _compare(headers.get("warc-block-digest"), block, "block")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = headers.get("warc-type", "")
    length, digest = len(payload), headers.get("warc-payload-digest", "").rpartition(":")[2]
    if kind == "revisit":
        found = re.search(rb"\r\ncontent-length:\s*(\d+)", http, re.I)
        length = int(found[1]) if found else None
    else:
        _compare(headers.get("warc-payload-digest"), payload, "payload")
        digest = hashlib.sha256(payload).hexdigest()
    number = lambda name: int(headers[name]) if re.fullmatch(r"-?\d+", headers.get(name, "")) else None
    return {
        "page_id": number("x-page-id"),
        "url": headers.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": number("x-refers-to-page-id"),
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": None if kind == "revisit" else payload,
    }


def _compare(named: str | None, data: bytes, what: str) -> None:
    algorithm, _, digest = (named or "").partition(":")
    if algorithm == "sha256" and hashlib.sha256(data).hexdigest() != digest:
        raise Damaged(f"{what} digest differs")


# ---------------------------------------------------------------- salvage


class Archive:
    """Random access to a file, a block at a time, so memory does not grow with the file."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.block = file, size, 0, b""

    def read(self, begin: int, count: int) -> bytes:
        count = max(0, min(count, self.size - begin))
        if not (self.at <= begin and begin + count <= self.at + len(self.block)):
            self.file.seek(begin)
            self.at, self.block = begin, self.file.read(min(max(count, BLOCK), self.size - begin))
        return self.block[begin - self.at : begin - self.at + count]

    def find(self, sign: bytes, begin: int) -> int:
        """The next place of ``sign`` at or after ``begin``, or the file's size."""
        while begin < self.size:
            part = self.read(begin, BLOCK)
            found = part.find(sign)
            if found >= 0:
                return begin + found
            begin += max(1, len(part) - len(sign) + 1)
        return self.size


def salvage(archive: Archive):
    """(begin, end, fields) of every sound record and (begin, end, reason) of every gap, in order."""
    at, bad = 0, None
    while at < archive.size:
        packed = archive.read(at, 3) == GZIP
        try:
            found = Member(archive, at) if packed else None
            end, fields = (found.end, None) if packed else _plain_at(archive, at)
        except Damaged as damage:
            bad, at = bad or (at, str(damage)), _next_sign(archive, at + 1)
            continue
        if not packed:
            if bad:
                yield bad[0], at, bad[1]
                bad = None
            yield at, end, fields
            at = end
            continue
        # a member that unpacks to its end has no other members inside it
        sound, inner, last = 0, [found.reason] if found.reason else [], end or at
        for record in found.records():
            if isinstance(record, str):
                inner.append(record)
                continue
            if bad:
                yield bad[0], at, bad[1]
                bad = None
            sound += 1
            yield at, last, record
        if not inner and not sound:
            inner = ["empty member"]
        if inner:
            bad = bad or (at, "; ".join(inner))
            at = end if end else _next_sign(archive, at + 1)
        else:
            if bad:
                yield bad[0], at, bad[1]
                bad = None
            at = end
    if bad:
        yield bad[0], archive.size, bad[1]


def _next_sign(archive: Archive, begin: int) -> int:
    """The next place that looks like the start of a gzip member of a record, or of a plain record."""
    plain = archive.find(b"WARC/1.", begin)
    at = archive.find(GZIP, begin)
    while at < plain:
        if _first_bytes(archive, at, 7) == b"WARC/1.":
            return at
        at = archive.find(GZIP, at + 1)
    return plain


def _first_bytes(archive: Archive, at: int, count: int) -> bytes:
    """What a gzip member's data begins with, however long its own header is; less if it does not unpack."""
    unpack, out = zlib.decompressobj(31), b""
    try:
        while len(out) < count and not unpack.eof and (piece := archive.read(at, 4096)):
            out += unpack.decompress(piece, count - len(out))
            at += len(piece)
    except zlib.error:
        pass
    return out


class Member:
    """A gzip member of any size: unpacked once to see where and how it ends, then record by record.

    ``end`` is None if it does not unpack to its end, ``reason`` then says why. A member of up to
    ``HELD`` bytes is kept from the first time; a larger one is unpacked again for its records.
    """

    HELD = 4 << 20

    def __init__(self, archive: Archive, begin: int):
        self.archive, self.begin, self.end, self.reason = archive, begin, None, None
        held, self.size = [], 0
        for part in self._parts():
            self.size += len(part)
            if held is not None:
                held.append(part)
                held = held if self.size <= self.HELD else None
        self.held = held

    def _parts(self):
        """The unpacked data in bounded pieces."""
        unpack, at, waiting = zlib.decompressobj(31), self.begin, b""
        while not unpack.eof:
            if not waiting:
                waiting = self.archive.read(at, BLOCK // 4)
                at += len(waiting)
                if not waiting:
                    self.reason = "member is cut off"
                    return
            before, part = unpack.copy(), None
            try:
                part = unpack.decompress(waiting, BLOCK)
            except zlib.error as error:
                self.reason = f"member does not unpack: {error}"
                yield _unpacked(before, waiting)
                return
            yield part
            waiting = unpack.unconsumed_tail
            while len(part) == BLOCK and not waiting and not unpack.eof:
                part = unpack.decompress(b"", BLOCK)  # what the limit held back
                yield part
        self.end = at - len(unpack.unused_data)

    def records(self):
        """The fields of its sound records, and a reason for each inner gap.

        In a member that does not unpack to its end, a record counts if its block digest vouches for it.
        """
        parts = iter(self.held) if self.held is not None else self._parts()
        data, base, at, bad = bytearray(), 0, 0, None

        def more() -> bool:
            part = next(parts, None)
            if part is None:
                return False
            data.extend(part)
            return True

        def gap(until: int) -> str:
            return f"{bad[1]} in member at {self.begin}, unpacked bytes {bad[0]} to {until}"

        while True:
            while at >= len(data):
                if not more():
                    return
            if at > BLOCK:  # let go of what is done
                del data[:at]
                base, at = base + at, 0
            try:
                length = _record_length(data, at, more, self.size - base - at)
                headers, block, _ = parse_record(bytes(data[at : at + length]))
                if self.reason and not headers.get("warc-block-digest", "").startswith("sha256:"):
                    raise Damaged("no digest vouches for the record")
                record = checked(headers, block)
            except Damaged as damage:
                bad = bad or (base + at, str(damage))
                at += 1
                while (found := data.find(b"WARC/1.", at)) < 0:
                    at = max(at, len(data) - 6)
                    if at > BLOCK:
                        del data[:at]
                        base, at = base + at, 0
                    if not more():
                        yield gap(base + len(data))
                        return
                at = found
                continue
            if bad:
                yield gap(base + at)
                bad = None
            yield record
            at += length


def _unpacked(unpack, piece: bytes) -> bytes:
    """What comes out of a piece before the byte that fails."""
    out = []
    try:
        for i in range(len(piece)):
            out.append(unpack.decompress(piece[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(out)


_LENGTH = re.compile(rb"\r\nContent-Length:\s*(\d+)\s*\r\n", re.I)


def _record_length(data: bytearray, at: int, more, left: int) -> int:
    """How long the record at a place says it is; reads on until it is there whole."""
    while len(data) - at < 10 and more():
        pass
    if not data.startswith(VERSIONS, at):
        raise Damaged("no version line")
    looked = at
    while (head := data.find(b"\r\n\r\n", looked)) < 0:
        looked = max(at, len(data) - 3)
        if not more():
            raise Damaged("headers do not end")
    length = _LENGTH.search(data, at, head + 2)
    if not length:
        raise Damaged("no content length")
    size = head + 8 - at + int(length[1])
    if size > left:
        raise Damaged("record does not end where its length says")
    while len(data) - at < size and more():
        pass
    return size


def _plain_at(archive: Archive, begin: int) -> tuple[int, dict]:
    """The end and the fields of the plain record at a place, whose headers may have any length."""
    data, at = bytearray(), begin

    def more() -> bool:
        nonlocal at
        part = archive.read(at, 1 << 16)
        at += len(part)
        data.extend(part)
        return bool(part)

    size = _record_length(data, 0, more, archive.size - begin)
    headers, block, _ = parse_record(bytes(data[:size]))
    return begin + size, checked(headers, block)


# ---------------------------------------------------------------- Spark


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def first_pages(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``pages`` with digest, first (the smallest page_id of equal payloads) and whether to revisit it."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    # short payloads never are revisits: they get keys of their own, which no first has and which spread them
    short = F.concat(F.lit("short "), F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 20)))
    keyed = rows.withColumn("key", F.when(F.octet_length("payload") >= least_bytes, F.col("digest")).otherwise(short))
    firsts = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy(F.col("digest").alias("key"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("key", "first")
    )
    later = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return with_totals(keyed, firsts, ["key"], "left").drop("key").withColumn("later", later)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 100, file_bytes: int = 32 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write all pages as records below ``folder``; the manifest of the files, stored."""

    def write(batches):
        filesystem, root = _opened(folder)
        filesystem.create_dir(root, recursive=True)
        name = sink = None
        records = size = 0

        def closed():
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first", "later")]
            for page_id, url, payload, digest, first, later in zip(*columns):
                if sink is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    sink, records, size = filesystem.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = member(record_bytes(page_id, url, payload, digest, first, later, date))
                sink.write(data)
                records, size = records + 1, size + len(data)
                if size >= file_bytes:
                    yield closed()
                    sink = None
        if sink is not None:
            yield closed()

    return stored(first_pages(pages, least_bytes).mapInArrow(write, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All sound records (kind ``record``) and quarantined byte ranges (kind ``gap``) of the archives.

    ``manifest`` has the archives' paths; one task reads whole files, block by block.
    """
    names = [column.split()[0] for column in RECORD.split(", ")]
    schema = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if kind == "long" else pa.string()) for n, kind in (c.split() for c in RECORD.split(", "))])

    def rows_of(path):
        filesystem, inner = _opened(path)
        with filesystem.open_input_file(inner) as file:
            for begin, end, found in salvage(Archive(file, file.size())):
                row = dict.fromkeys(names) | {"archive": path, "begin": begin, "finish": end}
                if isinstance(found, str):
                    yield row | {"kind": "gap", "reason": found}
                else:
                    yield row | {"kind": "record"} | found | ({} if payloads else {"payload": None})

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                for row in rows_of(path):
                    held.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size > BLOCK:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(read, RECORD)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read their records back."""
    folder = new_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_archives(write_archives(pages, folder), payloads=False)
