"""Suffix-array deduplication: remove every byte of a 50-byte string that an earlier document has too.

"Earlier" is a smaller doc_id. The texts are stored once, in files of about RUN_BYTES, and stay
there; what travels are sorted, packed runs, one for each file and bucket.

1. Most anchors (see ``suffix_runs``) stand in one document only, and no string around them can be
   found elsewhere. Each file sends its anchors and stretches as sorted runs of hashes; their merge
   tells which anchors have others to be compared with. This decides nothing else.
2. Around all other anchors each file sends each of its different stretches once, with the smallest
   doc_id that has it there: as the suffix from the anchor on, with the bytes before it, in sorted,
   front-coded runs, dealt out by ranges of the sorted order. Loser trees that never compare a known
   prefix again merge the runs; suffixes with the same anchor come out side by side, equal ones as
   one, and the strings of the different ones are compared byte by byte.
3. Around an anchor with very many different stretches (more than CROWD in one file, or more than
   CROWD_ALL in all) no stretches are compared. A string is decided by its own bytes, so each file
   sends each of its different strings there once, with the smallest doc_id, dealt out by the
   string's own hash; equal strings meet and nothing else of the anchor has to.
4. Each file marks the bytes that earlier documents have.

A hash only says what to compare: every byte that goes has been compared with that of an earlier
document, inside a file too. A group of copies costs one entry for each file that holds one of
them. A file sends at most CROWD of an anchor's stretches, and at most CROWD_ALL different ones of an
anchor are merged in one task. A task holds one file or one bucket.

Defined results: a null text is empty; texts below 50 bytes stay whole; a null doc_id counts as
larger than all others; rows that share a doc_id do not remove each other's text; repeated rows
with different doc_ids leave the first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from odskein.llm.shared import carried, given_back, let_go, new_path, return_memory, stored
from odskein.llm.token_files import same_bytes
from odskein.llm.suffix_runs import GRAM, LEAST, Run, differences, front_code, merge, pack, spread, stretches, string_keys, unpack, windows

# Text in a file, and text whose stretches share a bucket: what one task holds at a time, with about
# thirty bytes of arrays for each byte. Larger values suit larger executors and mean fewer packets.
RUN_BYTES = 12 << 20
BUCKET_BYTES = 6 << 20
SLICE = 1 << 16
SAMPLE = 32
# Different stretches of one anchor, in a file and in all, beyond which its strings go out one by one.
CROWD = 32
CROWD_ALL = 1 << 16
LAST_ID = np.iinfo(np.int64).max
PACKET = "run string, state string, bucket int, packet binary"


# ---------------------------------------------------------------- files of texts


def _file(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_runs(docs: DataFrame, folder: str, run_bytes: int) -> DataFrame:
    """Store whole rows in files of about ``run_bytes`` of text: their paths, sizes and sample strings."""

    def write(batches):
        let_go()
        filesystem, root = _file(folder)
        filesystem.create_dir(root, recursive=True)
        held, size = [], 0

        def closed():
            table = pa.Table.from_batches(held)
            name = f"run-{uuid.uuid4().hex}.arrow"
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with filesystem.open_output_stream(f"{root}/{name}", compression=None) as sink:
                with pa.ipc.new_file(sink, table.schema, options=options) as out:
                    out.write_table(table)
            text, _ = _text_of(table)
            starts = np.linspace(0, max(0, len(text) - LEAST), SAMPLE).astype(np.int64)
            sample = [text[i : i + LEAST].tobytes() for i in starts if i + LEAST <= len(text)]
            return pa.RecordBatch.from_pydict(
                {"run": [f"{folder}/{name}"], "size": pa.array([size], pa.int64()), "sample": pa.array([sample], pa.list_(pa.binary()))}
            )

        for batch in batches:
            first = 0
            for i, length in enumerate(len(text) for text in batch.column("plain").to_pylist()):
                size += length
                if size >= run_bytes:
                    held.append(batch.slice(first, i + 1 - first))
                    yield closed()
                    held, size, first = [], 0, i + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield closed()

    return stored(docs.mapInArrow(write, "run string, size long, sample array<binary>"), "text-runs")


def _text_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after the other, and where each ends."""
    texts = table.column("plain").to_pylist()
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts], dtype=np.int64)


def _ids_of(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").cast(pa.int64()).combine_chunks().fill_null(LAST_ID).to_numpy(zero_copy_only=False)


def _read_run(path: str) -> pa.Table:
    filesystem, inner = _file(path)
    with filesystem.open_input_file(inner) as source:
        return pa.ipc.open_file(source).read_all()


class _Classes:
    """The different stretches of a file, in (gram, whole) order, with the smallest doc_id of each.

    Stretches of one class are equal byte by byte.
    """

    def __init__(self, table: pa.Table):
        self.text, self.ends = _text_of(table)
        self.found = stretches(self.text, self.ends)
        self.doc = _ids_of(table)[np.searchsorted(self.ends, self.found.first, "right")]
        order = np.lexsort((self.doc, self.found.whole, self.found.gram))
        gram, whole, doc = self.found.gram[order], self.found.whole[order], self.doc[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1])
        first, size, before = (x[order] for x in (self.found.first, self.found.last - self.found.first + LEAST, self.found.anchor - self.found.first))
        again = np.flatnonzero(~fresh)
        alike = (size[again] == size[again - 1]) & (before[again] == before[again - 1])
        alike[alike] = same_bytes(self.text, first[again[alike]], self.text, first[again[alike] - 1], size[again[alike]])
        fresh[again[~alike]] = True
        head = np.flatnonzero(fresh)
        self.of = np.empty(len(order), np.int64)  # the class of each stretch
        self.of[order] = np.cumsum(fresh) - 1
        self.gram, self.whole, self.least = gram[head], whole[head], doc[head]
        tail = np.concatenate([head[1:] - 1, [len(order) - 1]]) if len(head) else head
        self.several = doc[tail] != doc[head]  # more than one doc_id in this file
        turn = np.ones(len(head), bool)
        turn[1:] = self.gram[1:] != self.gram[:-1]
        many = np.diff(np.append(np.flatnonzero(turn), len(head)))
        self.crowded = np.repeat(many > CROWD, many)
        self.sent = ~self.crowded | turn  # of a crowded anchor's classes only the first goes out


def _bounds(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of the sorted hashes begins and ends."""
    edges = [np.uint64((i << 64) // buckets) for i in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(hashes, np.array(edges, np.uint64), "left"), [len(hashes)]])


# ---------------------------------------------------------------- the four kinds of task


def _send_classes(buckets: int):
    def run(batches):
        let_go()
        for batch in batches:
            for path in batch.column("run").to_pylist():
                own = _Classes(_read_run(path))
                flags = own.several.astype(np.uint8) | own.crowded.astype(np.uint8) << 1
                gram, whole, least, flags = (a[own.sent] for a in (own.gram, own.whole, own.least, flags))
                bounds = _bounds(gram, buckets)
                filled = np.flatnonzero(np.diff(bounds)).tolist()
                for b in filled or [0]:  # a file without any comes through too
                    part = slice(bounds[b], bounds[b + 1])
                    yield _packet(path, "", b, pack(differences(gram[part]), whole[part], least[part], flags[part]))
                del own, gram, whole, least, flags
                return_memory()

    return run


def _join_classes(batches):
    """Of each class in a bucket: 0 if no other entry has its anchor and another document, 1 if one
    has, 3 if the anchor is crowded."""
    for bucket, rows in _groups(batches, "bucket"):
        runs = [unpack(blob) for _, _, _, blob in rows]
        sizes = np.array([len(r[0]) for r in runs], np.int64)
        gram = np.concatenate([np.cumsum(r[0], dtype=np.uint64) for r in runs])
        whole, least, flags = (np.concatenate([r[i] for r in runs]) for i in (1, 2, 3))
        order = np.lexsort((whole, gram))
        g, w, d, flags = gram[order], whole[order], least[order], flags[order]
        kind = np.zeros(len(g), np.uint8)
        if len(g):
            new_gram = np.ones(len(g), bool)
            new_gram[1:] = g[1:] != g[:-1]
            new_class = new_gram.copy()
            new_class[1:] |= w[1:] != w[:-1]
            heads = np.flatnonzero(new_gram)
            several = np.diff(np.append(heads, len(g))) > 1
            several &= (np.minimum.reduceat(d, heads) != np.maximum.reduceat(d, heads)) | (np.bitwise_or.reduceat(flags, heads) & 1 == 1)
            crowded = (np.bitwise_or.reduceat(flags, heads) > 1) | (np.add.reduceat(new_class, heads, dtype=np.int64) > CROWD_ALL)
            kind[order] = np.where(crowded, 3, several)[np.cumsum(new_gram) - 1]
        at = 0
        for (path, *_), size in zip(rows, sizes.tolist()):
            yield _packet(path, "", bucket, pack(kind[at : at + size]))
            at += size
        del runs, gram, whole, least, flags, order, g, w, d, kind
        return_memory()


def _send_suffixes(splitters: list[bytes], buckets: int):
    strings_from = len(splitters) + 1  # buckets of strings come after those of suffixes

    def run(batches):
        for path, rows in _groups(batches, "run"):
            own = _Classes(_read_run(path))
            kind = np.full(len(own.gram), 3, np.uint8)
            kind[own.sent] = np.concatenate([unpack(blob)[0] for _, _, _, blob in rows])
            of, found = own.of, own.found
            # other documents of this file that have the very stretch
            gone = (kind[of] != 3) & (own.doc > own.least[of])
            crowd = _Strings(own, np.flatnonzero(kind[of] == 3))
            # each class that is to be compared, by one of its stretches
            asks = np.flatnonzero((kind[of] == 1) & ~gone)
            classes, one = np.unique(of[asks], return_index=True)
            one = asks[one]
            text = own.text.tobytes()
            suffixes = [text[a:b] for a, b in zip(found.anchor[one].tolist(), (found.last[one] + LEAST).tolist())]
            order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            suffixes = [suffixes[i] for i in order]
            one, holders = one[order], own.least[classes][order]
            lefts = [text[a:b] for a, b in zip(found.first[one].tolist(), found.anchor[one].tolist())]
            state = f"{path}.{uuid.uuid4().hex}"
            filesystem, inner = _file(state)
            number = rank[np.searchsorted(classes, of[asks])]
            sizes = found.last[one] - found.first[one] + 1
            with filesystem.open_output_stream(inner, compression=None) as sink:
                begins, lasts = (np.concatenate([part[gone], crowd.gone]) for part in (found.first, found.last))
                sink.write(pack(begins, lasts, sizes, found.first[asks], number, crowd.asking, crowd.number, np.array([strings_from])))
            del found, text
            # the file's own entry, so that files without suffixes come through too
            yield _packet(path, state, -1 - zlib.crc32(path.encode()) % strings_from, b"")
            at = 0
            places = [bisect_left(suffixes, edge) for edge in splitters]
            for bucket, end in enumerate([*places, len(suffixes)]):
                if end > at:
                    left = lefts[at:end]
                    left_sizes = np.fromiter(map(len, left), np.uint8, len(left))
                    left_bytes = np.frombuffer(b"".join(left), np.uint8)
                    yield _packet(path, state, bucket, pack(*front_code(suffixes[at:end]), left_sizes, left_bytes, holders[at:end]))
                at = end
            bounds = _bounds(crowd.key, buckets)
            for b in range(buckets):
                part = slice(bounds[b], bounds[b + 1])
                if part.stop > part.start:
                    yield _packet(path, state, strings_from + b, pack(windows(own.text)[crowd.start[part]].ravel(), crowd.least[part]))
            del own, suffixes, lefts, crowd
            return_memory()

    return run


class _Strings:
    """The different strings of some stretches, in the order of their hashes, with the smallest doc_id
    of each. Equal hashes with different bytes stay apart (a string may then have several entries)."""

    def __init__(self, own: _Classes, which: np.ndarray):
        times = own.found.last[which] - own.found.first[which] + 1
        start, doc = spread(own.found.first[which], times), np.repeat(own.doc[which], times)
        key = string_keys(own.text, start)
        order = np.lexsort((doc, key))
        start, doc, key = start[order], doc[order], key[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        again = np.flatnonzero(~fresh)
        for at in range(0, len(again), SLICE):
            some = again[at : at + SLICE]
            texts = windows(own.text)
            fresh[some] = (texts[start[some]] != texts[start[some - 1]]).any(axis=1)
        head = np.flatnonzero(fresh)
        number = np.cumsum(fresh) - 1
        self.key, self.start, self.least = key[head], start[head], doc[head]
        first = doc == self.least[number] if len(head) else fresh
        self.gone = start[~first]
        self.asking, self.number = start[first], number[first]


def _merge(strings_from: int):
    def run(batches):
        for bucket, rows in _groups(batches, "bucket"):
            if bucket < 0:
                answers = [b""] * len(rows)
            else:
                answers = (_merge_suffixes if bucket < strings_from else _merge_strings)([unpack(blob) for *_, blob in rows])
            for (path, state, _, _), answer in zip(rows, answers):
                yield _packet(path, state, bucket, answer)
            return_memory()

    return run


def _merge_strings(parts: list) -> list[bytes]:
    """Of each string, whether an earlier document has it."""
    table = np.concatenate([p[0].reshape(-1, LEAST) for p in parts])
    doc = np.concatenate([p[1] for p in parts])
    order = np.argsort(table.view(f"S{LEAST}").ravel(), kind="stable")
    fresh = np.ones(len(order), bool)
    for at in range(1, len(order), SLICE):
        here = order[at : at + SLICE]
        fresh[at : at + SLICE] = (table[here] != table[order[at - 1 : at - 1 + len(here)]]).any(axis=1)
    smallest = np.minimum.reduceat(doc[order], np.flatnonzero(fresh))
    earlier = np.empty(len(order), np.uint8)
    earlier[order] = smallest[np.cumsum(fresh) - 1] < doc[order]
    return [pack(part) for part in np.split(earlier, np.cumsum([len(p[1]) for p in parts])[:-1])]


def _merge_suffixes(parts: list) -> list[bytes]:
    """Of each suffix, a bit for each string of its stretch that an earlier document has."""
    lefts = [_cut(p[4].tobytes(), p[3]) for p in parts]
    holders = [p[5].tolist() for p in parts]
    earlier = [[0] * len(h) for h in holders]
    runs = [Run(*p[:3]) for p in parts]
    group: dict = {}
    for run, at, shared in merge(runs):
        # suffixes with the same anchor share its bytes and follow one another
        if shared < GRAM:
            if group:
                _compare(group, earlier)
            group = {}
        group.setdefault((lefts[run][at], runs[run].string), []).append((holders[run][at], run, at))
    if group:
        _compare(group, earlier)
    return [pack(np.array(bits, np.int64)) for bits in earlier]


def _cut(data: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _compare(group: dict, earlier: list[list[int]]) -> None:
    """Compare the strings of the stretches around one anchor.

    ``group`` has (holder, run, position) of each suffix, by the stretch's bytes before and after the
    anchor's start. Of equal stretches all but the first holder's go whole; of different ones
    strings are compared, by how much of them stands before the anchor.
    """
    firsts = {}
    for (left, right), members in group.items():
        first = firsts[left, right] = min(members)[0]
        if len(members) > 1:
            whole = (1 << (len(left) + len(right) - LEAST + 1)) - 1
            for holder, run, at in members:
                if holder > first:
                    earlier[run][at] = whole
    if len(set(firsts.values())) < 2:
        return
    bits = dict.fromkeys(firsts, 0)
    for before in range(LEAST - GRAM + 1):
        after = LEAST - before
        smallest: dict[bytes, int] = {}
        there = []
        for (left, right), holder in firsts.items():
            if len(left) >= before and len(right) >= after:
                string = left[len(left) - before :] + right[:after]
                there.append((left, right, string, holder))
                if smallest.setdefault(string, holder) > holder:
                    smallest[string] = holder
        for left, right, string, holder in there:
            if smallest[string] < holder:
                bits[left, right] |= 1 << (len(left) - before)
    for key, found in bits.items():
        if found:
            for holder, run, at in group[key]:
                if holder == firsts[key]:
                    earlier[run][at] = found


def _mark(table: pa.Table, rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The file's bytes, where its documents end, and which bytes go."""
    filesystem, inner = _file(rows[0][1])
    with filesystem.open_input_stream(inner, compression=None) as source:
        first, last, sizes, asking, number, strings, string_number, (strings_from,) = unpack(source.read())
    bits = np.concatenate([np.empty(0, np.int64), *(unpack(blob)[0] for *_, b, blob in rows if 0 <= b < strings_from)])
    earlier = np.concatenate([np.empty(0, np.uint8), *(unpack(blob)[0] for *_, b, blob in rows if b >= strings_from)])
    # every stretch of an asking class has the strings of the one that was sent
    times = sizes[number]
    place = spread(np.zeros(len(asking), np.int64), times)
    gone = spread(asking, times)[(np.repeat(bits[number], times) >> place) & 1 == 1]
    gone = np.concatenate([gone, strings[earlier[string_number] == 1]])
    text, ends = _text_of(table)
    depth = np.zeros(len(text) + 1, np.int32)
    np.add.at(depth, np.concatenate([first, gone]), 1)
    np.add.at(depth, np.concatenate([last, gone]) + LEAST, -1)
    return text, ends, np.cumsum(depth[:-1]) > 0


DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(batches):
    for path, rows in _groups(batches, "run"):
        table = _read_run(path)
        text, ends, goes = _mark(table, rows)
        out = []
        begin = 0
        for doc_id, end in zip(table.column("doc_id").to_pylist(), ends.tolist()):
            gone = goes[begin:end]
            spans = int(np.count_nonzero(gone[1:] > gone[:-1])) + bool(len(gone) and gone[0])
            out.append((doc_id, end - begin, int(np.count_nonzero(gone)), spans, hashlib.sha256(text[begin:end][~gone].tobytes()).hexdigest()))
            begin = end
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(),) * 4 + (pa.string(),))]
        del table, text, ends, goes
        return_memory()
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in DIGESTS.split(", ")])


def _trim(names: list[str], text_at: int):
    def run(batches):
        for path, rows in _groups(batches, "run"):
            table = _read_run(path)
            text, ends, goes = _mark(table, rows)
            begins = np.concatenate([[0], ends[:-1]])
            # a character that loses some of its bytes goes as a whole
            kept = [text[a:b][~goes[a:b]].tobytes().decode("utf-8", "ignore") for a, b in zip(begins.tolist(), ends.tolist())]
            columns = [pa.chunked_array([pa.array(kept, pa.string())]) if i == text_at else table.column(f"c{i}") for i in range(len(names))]
            yield from pa.table(columns, names=[f"c{i}" for i in range(len(names))]).to_batches(max_chunksize=2000)
            del table, text, ends, goes, kept, columns
            return_memory()

    return run


# ---------------------------------------------------------------- exchange


def _packet(run: str, state: str, bucket: int, packet: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([run]), pa.array([state]), pa.array([bucket], pa.int32()), pa.array([packet], pa.binary())], names=["run", "state", "bucket", "packet"]
    )


def _groups(batches, key: str):
    """Runs of rows with an equal key, of batches sorted by it."""
    current, rows = None, []
    for batch in batches:
        packets = batch.column("packet")
        for i, names in enumerate(zip(*(batch.column(c).to_pylist() for c in ("run", "state", "bucket")))):
            row = (*names, packets[i].as_py())
            value = row[0] if key == "run" else row[2]
            if rows and value != current:
                yield current, rows
                rows = []
            current = value
            rows.append(row)
    if rows:
        yield current, rows


def _dealt(packets: DataFrame, count: int, key: str) -> DataFrame:
    """All packets of a key together, in order."""
    other = "bucket" if key == "run" else "run"
    return packets.repartition(count, key).sortWithinPartitions(key, other)


def _splitters(runs: DataFrame, buckets: int) -> list[bytes]:
    """Beginnings that cut the sorted order into parts of like size, from a sample of at most 4096 files.

    They are as long as an anchor, so suffixes with the same anchor stay together.
    """
    rows = runs.select("sample").orderBy(F.xxhash64("run")).limit(4096).collect()
    strings = sorted(bytes(s)[:GRAM] for row in rows for s in row["sample"])
    return sorted({strings[i * len(strings) // buckets] for i in range(1, buckets)}) if strings else []


def _marked(docs: DataFrame, run_bytes: int, bucket_bytes: int) -> DataFrame:
    """The packets that tell each file which of its strings earlier documents have."""
    spark = docs.sparkSession
    folder = new_path(spark, "texts")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    runs = write_runs(docs, folder, run_bytes)
    count, size = runs.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    files, buckets = max(1, count), max(1, -(-size // bucket_bytes))
    splitters = _splitters(runs, buckets)
    classes = runs.select("run").repartition(files, "run").mapInArrow(_send_classes(buckets), PACKET)
    kinds = _dealt(classes, buckets, "bucket").mapInArrow(_join_classes, PACKET)
    suffixes = _dealt(kinds, files, "run").mapInArrow(_send_suffixes(splitters, buckets), PACKET)
    earlier = _dealt(suffixes, buckets, "bucket").mapInArrow(_merge(len(splitters) + 1), PACKET)
    return _dealt(earlier, files, "run")


def _plain(docs: DataFrame, *more) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("plain"), *more)


def repeated_bytes(docs: DataFrame, run_bytes: int = RUN_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """For each document its bytes, how many go, in how many spans, and the digest of the rest."""
    return _marked(_plain(docs), run_bytes, bucket_bytes).mapInArrow(_digest, DIGESTS)


def without_repeats(docs: DataFrame, run_bytes: int = RUN_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The documents with all their columns, their texts without the repeated bytes."""
    others = [column for name, column in zip(docs.columns, carried(docs)) if name != "text"]
    schema = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    marked = _marked(_plain(docs, *others), run_bytes, bucket_bytes)
    return given_back(marked.mapInArrow(_trim(docs.columns, docs.columns.index("text")), schema), docs)
