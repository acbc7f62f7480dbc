"""Token ids in Parquet: encode, write in id order, read back selectively.

One row is one document: its id, its ids as a list column, and their number. The files are
ordered by document id, so the page index and the row groups' statistics let a reader skip to a
range of ids, and the column layout lets it read lengths without any ids. The list is
dictionary-encoded while its dictionary is small and packed by differences otherwise.

Defined results: a null text is an empty one (only the end id is written); a null doc_id sorts
first; repeated doc_ids keep all their rows, ordered by a hash of the text; an empty table writes
and reads no rows; columns other than the two named are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odskein.llm.shared import return_memory, worker_memo
from odskein.llm.wordhash import mixed, powers, prefix_sums

IDS_SCHEMA = "doc_id long, n_tokens long, ids array<int>"
# Text handled at once inside a task, in characters.
SLICE_CHARS = 1_000_000
# The same in bytes, for whole arrays.
SLICE_BYTES = 1_000_000
# Distinct pieces a worker remembers; beyond that it forgets those it has met only once.
KNOWN_PIECES = 800_000
# Distinct words of those who remember them in a dictionary.
CACHE_WORDS = 500_000
# A cut in front of a run of such white space is a cut of the tokenizer's too.
_SPACE = np.isin(np.arange(256), list(b" \n\t\r"))
OTHER_SPACE = re.compile(r"[^\S \n]")
# Bytes of plain words: ASCII letters, and the first bytes of the two that spell U+00C0 to U+027F and
# U+0400 to U+047F, which are letters but for two; what else is printed in ASCII and is no digit.
LETTER, MARK = 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum()]] = MARK
_KINDS[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA), 0xD0, 0xD1]] = LETTER
# The characters by which byte-level tokenizers name the bytes.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_NAMES = np.arange(256, dtype="<u2")
_NAMES[[b for b in range(256) if b not in _SHOWN]] = np.arange(256, 512 - len(_SHOWN))


class KnownPieces:
    """The pieces a worker remembers, as arrays: spelling, hash, ids, and how often they were met.

    A hash finds a piece and its spelling decides. Pieces are looked up in two sorted lists of
    hashes, a long one and a short one of those that came last, so that adding some is cheap; so are
    the arrays longer than what they hold.
    """

    def __init__(self):
        self.count = self.spelled_to = self.flat_to = 0
        self.spelled = np.empty(0, np.uint8)
        self.flat = np.empty(0, np.int32)
        self.begins, self.starts, self.sizes, self.uses = (np.empty(0, np.int64) for _ in range(4))
        self.lengths = np.empty(0, np.int64)
        self.whole = np.empty(0, bool)
        self.lists = [(np.empty(0, np.uint64), np.empty(0, np.int64))] * 2

    def __len__(self) -> int:
        return self.count

    def find(self, hashes: np.ndarray, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each piece of ``data``; -1 if it is not known, -2 if another has its hash.

        Hashes in ascending order are found fastest.
        """
        numbers = np.full(len(hashes), -1)
        for keys, values in self.lists:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                met = np.flatnonzero(keys[at] == hashes)
                found = values[at[met]]
                same = self.lengths[found] == lengths[met]
                same[same] = same_bytes(data, begins[met[same]], self.spelled, self.begins[found[same]], lengths[met[same]])
                numbers[met] = np.where(same, found, -2)
        return numbers

    def add(self, hashes: np.ndarray, spelled: np.ndarray, lengths: np.ndarray, flat: np.ndarray, sizes: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Remember new pieces, no two of one hash; their numbers."""
        count = self.count
        numbers = np.arange(count, count + len(hashes))
        self.begins = _put(self.begins, count, self.spelled_to + np.cumsum(lengths) - lengths)
        self.spelled = _put(self.spelled, self.spelled_to, spelled)
        self.lengths = _put(self.lengths, count, lengths)
        self.starts = _put(self.starts, count, self.flat_to + np.cumsum(sizes) - sizes)
        self.flat = _put(self.flat, self.flat_to, flat)
        self.sizes = _put(self.sizes, count, sizes)
        self.whole = _put(self.whole, count, whole)
        self.uses = _put(self.uses, count, np.zeros(len(hashes), np.int64))
        self.count, self.spelled_to, self.flat_to = count + len(hashes), self.spelled_to + len(spelled), self.flat_to + len(flat)
        long, short = self.lists
        short = _merged(short, (hashes, numbers))
        if len(short[0]) > max(100_000, len(long[0]) // 8):
            long, short = _merged(long, short), (short[0][:0], short[1][:0])
        self.lists = [long, short]
        return numbers

    def kept(self, most: int) -> "KnownPieces":
        """Those met more than once, the ``most`` frequent of them, counted anew."""
        chosen = np.flatnonzero(self.uses[: self.count] > 1)
        if len(chosen) > most:
            chosen = np.sort(chosen[np.argsort(-self.uses[chosen], kind="stable")[:most]])
        hashes = np.empty(len(self), np.uint64)
        for keys, values in self.lists:
            hashes[values] = keys
        lengths, sizes = self.lengths[chosen], self.sizes[chosen]
        few = KnownPieces()
        spelled = self.spelled[ranges(self.begins[chosen], lengths)]
        few.add(hashes[chosen], spelled, lengths, self.flat[ranges(self.starts[chosen], sizes)], sizes, self.whole[chosen])
        return few


def _put(held: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``held``, or a longer copy, with ``more`` written behind its first ``at`` values."""
    if at + len(more) > len(held):
        longer = np.empty(max(at + len(more), len(held) * 3 // 2), held.dtype)
        longer[:at] = held[:at]
        held = longer
    held[at : at + len(more)] = more
    return held


def _merged(*lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, values = (np.concatenate(columns) for columns in zip(*lists))
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order]


def same_bytes(a: np.ndarray, a_begins: np.ndarray, b: np.ndarray, b_begins: np.ndarray, lengths: np.ndarray, at_once: int = 1 << 19) -> np.ndarray:
    """Whether stretches of the same length (at least one byte) in two arrays are equal."""
    same = np.empty(len(lengths), bool)
    sums = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(sums, (sums[first - 1] if first else 0) + at_once)))
        sizes = lengths[first:last]
        differ = a[ranges(a_begins[first:last], sizes)] != b[ranges(b_begins[first:last], sizes)]
        same[first:last] = ~np.logical_or.reduceat(differ, np.cumsum(sizes) - sizes)
        first = last
    return same


class WordEncoder:
    """Ids of texts from a byte-level tokenizer, which sees each distinct word once.

    Such a tokenizer never merges across the start of a run of white space that follows other
    text, so a text's ids are those of its pieces, in order; a piece is a run of white space and the
    word behind it. Where the tokenizer's pattern is known, a mark behind an ASCII letter starts a
    piece too. Texts that hold an added token, or words that begin or end in other white space, are
    encoded whole.

    Pieces are found and told apart by whole arrays. Of pieces with one hash the last stands for
    those that equal it byte by byte; where two different pieces have one hash, the text of the one
    that is not remembered is encoded whole.

    A new piece goes through the whole tokenizer, unless its cuts are plain: the tokenizer's own
    pattern leaves a word of letters in one part with the blank in front of it, and the marks behind it
    in another. Such parts go to the tokenizer's model itself.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        added = [t.content.encode("utf-8") for t in tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added)) or rb"(?!)")
        # every token spells as many bytes as its name has characters
        self.bytes_of = np.zeros(tokenizer.get_vocab_size(), np.int64)
        for token, i in tokenizer.get_vocab().items():
            self.bytes_of[i] = len(token)
        self.known = KnownPieces()
        self.model = _model_alone(tokenizer)
        self.table = np.zeros(1 << 20, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the number of ids of each text."""
        raw = [text.encode("utf-8") for text in texts]
        return self.encode_bytes(b"".join(raw), np.cumsum([0, *map(len, raw)]))

    def encode_bytes(self, raw: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts in UTF-8 that stand one after the other, with ``bounds`` between them."""
        if len(self.known) > KNOWN_PIECES:
            self.known = self.known.kept(KNOWN_PIECES // 2)
        data = np.frombuffer(raw, np.uint8)
        space = _SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[1:-1] = space[1:] & ~space[:-1]
        if self.model is not None:
            kinds = _KINDS[data]
            first[1:-1] |= (kinds[1:] == MARK) & (kinds[:-1] == LETTER) & (data[:-1] < 0x80)
        first[bounds] = True
        first[-1] = False
        begins = np.flatnonzero(first)
        ends = np.append(begins[1:], len(data))[: len(begins)]
        parts, last = [], 0
        while last < len(begins):  # long texts are cut between pieces
            upto = max(last + 1, int(np.searchsorted(begins, begins[last] + SLICE_BYTES)))
            parts.append(self._numbers(raw, data, begins[last:upto], ends[last:upto]))
            last = upto
        which = np.concatenate(parts) if parts else np.empty(0, np.int64)
        known = self.known
        np.add.at(known.uses, which[which >= 0], 1)
        # a piece without a number makes its text odd, so its ids do not matter
        strange, which = which < 0, np.maximum(which, 0)
        sizes = known.sizes[which]
        before = np.concatenate([[0], np.cumsum(sizes)])
        counts = np.diff(before[np.searchsorted(begins, bounds)])
        ids = known.flat[ranges(known.starts[which], sizes)]
        odd = {int(np.searchsorted(bounds, found.start(), "right")) - 1 for found in self.added.finditer(raw)}
        odd.update((np.searchsorted(bounds, begins[strange | known.whole[which]], "right") - 1).tolist())
        if odd:
            at, parts, last = np.cumsum(counts), [], 0
            for i in sorted(odd):
                parts.append(ids[last : at[i] - counts[i]])
                text = raw[bounds[i] : bounds[i + 1]].decode("utf-8")
                whole = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
                parts.append(whole)
                last = at[i]
                counts[i] = len(whole)
            ids = np.concatenate([*parts, ids[last:]])
        return ids, counts

    def _numbers(self, raw: bytes, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each piece, -2 for one whose hash another piece has; new ones are learnt."""
        sums = prefix_sums(data[begins[0] : ends[-1]])
        at = begins - begins[0]
        hashes = mixed((sums[ends - begins[0]] - sums[at]) * powers(len(sums))[1][at])
        del sums
        table = self.table
        slot = (hashes >> np.uint64(44)).astype(np.int64)
        place = np.arange(len(begins))
        table[slot] = place  # the last piece of a slot stands for those that equal it
        model = table[slot].astype(np.int64)
        lengths = ends - begins
        copies = np.flatnonzero((model != place) & (hashes == hashes[model]) & (lengths == lengths[model]))
        copies = copies[same_bytes(data, begins[copies], data, begins[model[copies]], lengths[copies])]
        alone = np.ones(len(begins), bool)
        alone[copies] = False
        model = np.where(alone, place, model)
        own = np.flatnonzero(alone)
        own = own[np.argsort(hashes[own])]
        numbers = self.known.find(hashes[own], data, begins[own], lengths[own])
        # of new pieces with one hash the first is learnt, the others are told apart by the next look
        fresh = np.flatnonzero(numbers == -1)
        new = hashes[own[fresh]]
        first = np.ones(len(fresh), bool)
        first[1:] = new[1:] != new[:-1]
        if len(fresh):
            learnt = own[fresh[first]]
            numbers[fresh[first]] = self._learn(raw, data, begins[learnt], ends[learnt], hashes[learnt])
            rest = fresh[~first]
            again = own[rest]
            numbers[rest] = self.known.find(hashes[again], data, begins[again], lengths[again])
        every = np.empty(len(begins), np.int64)
        every[own] = numbers
        return every[model]

    def _learn(self, raw: bytes, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The numbers of new pieces, which are remembered."""
        numbers = np.empty(len(begins), np.int64)
        lengths = ends - begins
        spelled = data[ranges(begins, lengths)]
        plain, letters = _plain(spelled, lengths)
        if self.model is None:
            plain[:] = False
        if plain.any():
            spelled = spelled[np.repeat(plain, lengths)]
            numbers[plain] = self._learn_plain(spelled, lengths[plain], letters[plain], hashes[plain])
        if not plain.all():
            numbers[~plain] = self._learn_any(raw, data, begins[~plain], ends[~plain], hashes[~plain])
        return numbers

    def _learn_plain(self, spelled: np.ndarray, lengths: np.ndarray, letters: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        text = _NAMES[spelled].tobytes().decode("utf-16-le")
        stops = np.cumsum(lengths)
        starts = stops - lengths
        broken = spelled[starts] == 10
        marks = starts + (broken | (spelled[starts] == 32)) + letters
        cuts = np.unique(np.concatenate([starts, starts[broken] + 1, marks, [len(text)]])).tolist()
        tokens = self.model.tokenize
        flat = np.array([t.id for a, b in pairwise(cuts) for t in tokens(text[a:b])], np.int32)
        return self.known.add(hashes, spelled, lengths, flat, self._sizes(flat, lengths), np.zeros(len(lengths), bool))

    def _sizes(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """How many ids each piece has, of which the lengths in bytes are given."""
        return np.diff(np.searchsorted(np.cumsum(self.bytes_of[flat]), np.cumsum(lengths), "left") + 1, prepend=0)

    def _learn_any(self, raw: bytes, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        # pieces of white space and a word keep their cuts side by side, so many are one text
        beside = _SPACE[data[begins]] & ~_SPACE[data[ends - 1]]
        order = np.argsort(~beside, kind="stable")
        begins, ends, hashes, many = begins[order], ends[order], hashes[order], int(beside.sum())
        pieces = [raw[b:e] for b, e in zip(begins.tolist(), ends.tolist())]
        texts = [b"".join(pieces[at : min(many, at + 64)]).decode("utf-8") for at in range(0, many, 64)]
        texts += [piece.decode("utf-8") for piece in pieces[many:]]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(lists), np.int32, sum(map(len, lists)))
        lengths = ends - begins
        odd = np.zeros(len(pieces), bool)
        if OTHER_SPACE.search("".join(texts)):
            odd[:] = [_odd(piece.decode("utf-8")) for piece in pieces]
        numbers = np.empty(len(pieces), np.int64)
        numbers[order] = self.known.add(hashes, np.frombuffer(b"".join(pieces), np.uint8), lengths, flat, self._sizes(flat, lengths), odd)
        return numbers


def _model_alone(tokenizer):
    """The tokenizer's model, which keeps no words; None if the cuts of plain words are not known for it."""
    from tokenizers import models

    said = json.loads(tokenizer.to_str())
    cuts, model = said["pre_tokenizer"] or {}, said["model"]
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if said["normalizer"] or said["truncation"] or said["padding"] or model["type"] != "BPE" or any(model.get(o) for o in options):
        return None
    if cuts.get("type") != "ByteLevel" or not cuts["use_regex"] or cuts["add_prefix_space"]:
        return None
    if not {chr(c) for c in _NAMES} <= model["vocab"].keys():
        return None
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    return models.BPE(model["vocab"], merges, cache_capacity=0)


def _plain(spelled: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pieces are a blank, a line break or nothing, then letters, then marks or nothing; bytes of letters."""
    stops = np.cumsum(lengths)
    starts = stops - lengths
    kinds = _KINDS[spelled]
    second = np.flatnonzero((kinds[:-1] == LETTER) & (spelled[:-1] >= 0x80)) + 1
    no_letter = (spelled[second - 1] == 0xC3) & ((spelled[second] == 0x97) | (spelled[second] == 0xB7))
    kinds[second] = np.where(no_letter, 0, LETTER)
    letter = kinds == LETTER
    spoilt = kinds == 0
    spoilt[1:] |= letter[1:] & (kinds[:-1] == MARK)
    spoilt[starts] = kinds[starts] == 0
    ahead = (spelled[starts] == 32) | (spelled[starts] == 10)
    spoilt[starts[ahead]] = False
    words = np.minimum(starts + ahead, stops - 1)
    return letter[words] & ~np.logical_or.reduceat(spoilt, starts), np.add.reduceat(letter, starts, dtype=np.int64)


def _odd(piece: str) -> bool:
    """Whether white space beyond the blanks and breaks in front of a piece could join its neighbours."""
    bare = piece.lstrip(" \n\t\r")  # what stands in front is white space that a cut may precede
    return bool(bare) and (bare[0].isspace() or bare[-1].isspace())


class Numbered(dict):
    """Numbers words in the order of their first use."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def slices(lengths: list[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``most`` characters each."""
    first = size = 0
    for i, length in enumerate(lengths):
        size += length
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(lengths):
        yield first, len(lengths)


def encode_ids(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """doc_id, n_tokens and ids (with the end id) of every document, in the rows' own order."""

    def encode(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = worker_memo(("words", tokenizer_path), lambda: WordEncoder(Tokenizer.from_file(tokenizer_path)))
        for batch in batches:
            texts = batch.column("text")
            bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            held = texts.buffers()[2]
            for first, last in slices(np.diff(bounds).tolist(), SLICE_BYTES):
                raw = held[int(bounds[first]) : int(bounds[last])].to_pybytes() if held else b""
                ids, counts = encoder.encode_bytes(raw, bounds[first : last + 1] - bounds[first])
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(np.int32)
                offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(counts + 1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                    names=["doc_id", "n_tokens", "ids"],
                )
            return_memory()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(encode, IDS_SCHEMA)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 0,
    row_group_bytes: int = 16 << 20,
    page_rows: int = 2_000,
    delta: bool = False,
) -> None:
    """Encode all documents and write them as Parquet, files and rows in ascending doc_id order.

    ``row_group_bytes`` and ``page_rows`` set how finely a reader can skip. ``delta`` packs the
    ids by differences instead of through a dictionary, for vocabularies too large for one.
    """
    key = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange(*key).sortWithinPartitions(*key)
    )
    (
        encode_ids(ordered, tokenizer_path, end_id)
        .write.option("compression", "zstd")
        .option("maxRecordsPerFile", "0")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .option("parquet.enable.dictionary", str(not delta).lower())
        .option("parquet.dictionary.page.size", str(4 << 20))
        .option("parquet.writer.version", "v2" if delta else "v1")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files; filters on doc_id and unread columns are skipped in the files."""
    return spark.read.schema(IDS_SCHEMA).parquet(path)


def token_starts(spark: SparkSession, path: str) -> DataFrame:
    """For each document of the files the number of ids before it, from lengths alone.

    Rows are numbered inside each file and the files' totals are added up over one row for each
    file, so no task sees more rows than a file has.
    """
    rows = read_token_files(spark, path).select("doc_id", "n_tokens", *_written_at())
    return _with_starts(spark, path, rows).select("doc_id", "start", "n_tokens")


def _written_at() -> list[Column]:
    """In which file a row stands, and where in it."""
    return [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]


def _with_starts(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` has file, row and n_tokens; the files' totals come from their lengths alone.

    A task's files are named by its number and, if it wrote several, by a count of their own.
    """
    written = [F.regexp_extract("file", pattern, 1).cast("long") for pattern in (r"part-(\d+)", r"-c(\d+)\.")]
    lengths = read_token_files(spark, path).select("n_tokens", _written_at()[0])
    files = lengths.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy(*written).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(files, "file").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))


def id_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids of every row of the files."""
    def digest(batches):
        for batch in batches:
            lists = batch.column("ids")
            values = lists.values.to_numpy().astype("<u4", copy=False)
            offsets = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "file", "row")] + [pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
                names=["doc_id", "file", "row", "n_tokens", "ids_crc32"],
            )

    rows = (
        read_token_files(spark, path)
        .select("doc_id", "ids", *_written_at())
        .mapInArrow(digest, "doc_id long, file string, row long, n_tokens long, ids_crc32 long")
    )
    return _with_starts(spark, path, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
