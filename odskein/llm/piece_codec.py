"""SentencePiece encoding and decoding through the tokenizers library.

The model file is read as the protobuf message it is; its normaliser, white-space marker, scores or
merges and byte fallback are rebuilt as a tokenizer of the other library, which encodes batches on
several threads. Words are encoded once for each worker: no piece reaches from one word into the
marker of the next (this is checked when the model is read; otherwise texts are encoded whole).

Parity with the model's own library is part of the job. Each distinct word is encoded by both, and a
word they disagree about keeps the ids of the model's own library. Every text is normalised by both. A text that they normalise differently is encoded whole by
the model's own library, as is every text if the model has user-defined pieces, and one of
``VERIFY_EVERY`` (by a checksum of the text) in any case; a difference in the normalised text or the
ids puts its ids in place and shows in the column ``parity``.

Defined results: a null text is empty and has no ids; characters that no piece covers become byte
pieces, or the unknown piece where the model has none; control pieces spelled in a text are plain
text; repeated rows are encoded one by one; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from odskein.llm.shared import return_memory, worker_memo
from odskein.llm.token_files import CACHE_WORDS, Numbered, _put, ranges, slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
VERIFY_EVERY = 64
# Text encoded at once, in characters, and new words that both libraries encode at once.
SLICE_CHARS = 250_000
FRESH_WORDS = 8192
# A second normaliser message, which is merged into the first: no character map, no prefix, no stripping.
_AS_SPELLED = b"\x1a\x06\x12\x00\x18\x00\x20\x00"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


# ---------------------------------------------------------------- the model file


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at += 1
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes):
    """(number, value) of a message's fields; numbers as integers, the rest as bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if kind == 2:
                size, at = _varint(data, at)
            if size is None:
                raise ValueError("not a model file")
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class PieceModel:
    """What the model file says about encoding."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_mark: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    strip_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown(self) -> int:
        return next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)


def read_model(data: bytes) -> PieceModel:
    """Parse a model file. Field numbers are those of the published message definition."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece[1].decode("utf-8"), score, piece.get(3, NORMAL)))
        elif number == 2:
            spec = dict(_fields(value))
            model.kind = spec.get(3, UNIGRAM)
            model.suffix_mark = bool(spec.get(24, 0))
            model.byte_fallback = bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix = bool(spec.get(3, 1))
            model.strip_spaces = bool(spec.get(4, 1))
            model.escape_spaces = bool(spec.get(5, 1))
    if model.kind not in (UNIGRAM, BPE) or model.suffix_mark or not model.escape_spaces:
        raise ValueError("only unigram and BPE models that mark the start of words can be rebuilt")
    return model


# ---------------------------------------------------------------- the rebuilt tokenizer


class Rebuilt:
    """Normaliser, encoder and decoder of a model, on the tokenizers library."""

    def __init__(self, model: PieceModel):
        from tokenizers import Tokenizer, models, normalizers

        self.model = model
        self.charsmap = normalizers.Precompiled(model.charsmap) if model.charsmap else None
        spelled = [p for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)]
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p in spelled)
        # pieces that never stand for text of their own get a spelling that no text has
        names = [p if kind in (NORMAL, USER_DEFINED, BYTE) else f"\U0010ffff{i}" for i, (p, _, kind) in enumerate(model.pieces)]
        if model.kind == UNIGRAM:
            vocabulary = [(name, score) for name, (_, score, _) in zip(names, model.pieces)]
            self.tokenizer = Tokenizer(models.Unigram(vocabulary, model.unknown, model.byte_fallback))
        else:
            ids = {name: i for i, name in enumerate(names)}
            self.tokenizer = Tokenizer(
                models.BPE(ids, _merges(model, ids), unk_token=names[model.unknown], fuse_unk=True, byte_fallback=model.byte_fallback)
            )
        self.bytes_of = [_spelled(p, kind) for p, _, kind in model.pieces]

    def normalise(self, text: str) -> str:
        """The text as the pieces spell it."""
        if self.charsmap is not None:
            text = self.charsmap.normalize_str(text)
        if self.model.strip_spaces:
            text = re.sub(" {2,}", " ", text.lstrip(" "))
        if not text:
            return ""
        text = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        return text.rstrip(MARK) if self.model.strip_spaces else text

    def words(self, normal: str) -> list[str]:
        return _WORDS.findall(normal) if self.by_word else [normal] if normal else []

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def decode(self, ids) -> str:
        """The text of the ids: marks as blanks, byte pieces joined, without the prefix's blank."""
        text = b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def _spelled(piece: str, kind: int) -> bytes:
    if kind == BYTE:
        return bytes([int(piece[3:5], 16)])
    if kind == CONTROL:
        return b""
    return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode()


def _merges(model: PieceModel, ids: dict[str, int]) -> list[tuple[str, str]]:
    """All ways to make a piece of two others, best score first."""
    usable = {p for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, score, kind in model.pieces:
        if kind in (NORMAL, USER_DEFINED):
            for i in range(1, len(piece)):
                left, right = piece[:i], piece[i:]
                if left in usable and right in usable:
                    found.append((-score, ids[piece], ids[left], ids[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


class Codec:
    """Encodes batches of texts, remembering words, with parity to the model's own library."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.rebuilt = Rebuilt(read_model(data))
        self.own = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=data + _AS_SPELLED)
        # user-defined pieces are cut out before words are, so only whole texts tell
        self.whole = any(kind == USER_DEFINED for _, _, kind in self.rebuilt.model.pieces)
        self.forget()

    def forget(self) -> None:
        self.known, self.flat = Numbered(), np.empty(0, np.int32)
        self.starts, self.sizes, self.replaced = (np.empty(0, np.int64) for _ in range(3))
        self.count = self.flat_to = 0

    def _learn(self) -> None:
        """Encode the new words; the arrays are longer than what they hold."""
        fresh, self.known.fresh = self.known.fresh, []
        for at in range(0, len(fresh), FRESH_WORDS):
            words = fresh[at : at + FRESH_WORDS]
            lists = self.rebuilt.encode_words(words)
            theirs = self.plain.encode(words, num_threads=1)
            changed = [a != b for a, b in zip(lists, theirs)]
            lists = [b if c else a for a, b, c in zip(lists, theirs, changed)]
            sizes = np.fromiter((len(x) for x in lists), np.int64, len(lists))
            total = int(sizes.sum())
            self.starts = _put(self.starts, self.count, self.flat_to + np.cumsum(sizes) - sizes)
            self.sizes = _put(self.sizes, self.count, sizes)
            self.replaced = _put(self.replaced, self.count, np.array(changed, np.int64))
            self.flat = _put(self.flat, self.flat_to, np.fromiter((i for x in lists for i in x), np.int32, total))
            self.count, self.flat_to = self.count + len(words), self.flat_to + total

    def encode(self, texts: list[str]):
        """Ids of each text, words that took the other library's ids, and whether parity held."""
        if len(self.known) > CACHE_WORDS:
            self.forget()
        normal = [self.rebuilt.normalise(text) for text in texts]
        same = [a == b for a, b in zip(normal, self.own.normalize(texts))] if texts else []
        cut = [self.rebuilt.words(text) for text in normal]
        counts = np.fromiter((len(c) for c in cut), np.int64, len(cut))
        number = self.known.__getitem__
        which = np.fromiter((number(w) for c in cut for w in c), np.int64, int(counts.sum()))
        self._learn()
        owner = np.repeat(np.arange(len(texts)), counts)
        sizes = self.sizes[which]
        lengths = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)
        replaced = np.bincount(owner, weights=self.replaced[which], minlength=len(texts)).astype(np.int64)
        lists = np.split(self.flat[ranges(self.starts[which], sizes)], np.cumsum(lengths)[:-1]) if texts else []
        parity = [True] * len(texts)
        for i, text in enumerate(texts):
            if not same[i] or self.whole or zlib.crc32(text.encode("utf-8", "replace")) % VERIFY_EVERY == 0:
                whole = np.array(self.own.encode(text), np.int32)
                if not same[i] or not np.array_equal(whole, lists[i]):
                    parity[i], lists[i] = False, whole
        return lists, replaced, parity


# ---------------------------------------------------------------- Spark


def _started(model_path: str, threads: int) -> Codec:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(threads)

    def made() -> Codec:
        with open(model_path, "rb") as file:
            return Codec(file.read())

    return worker_memo(("pieces", model_path), made)


ADDED = [StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()), StructField("n_replaced", LongType()), StructField("parity", BooleanType()), StructField("round_trip", BooleanType())]


def encoded(docs: DataFrame, model_path: str, threads: int = 2) -> DataFrame:
    """The documents without their text, with ids, their number, replaced words, parity and round trip.

    ``round_trip`` says that the decoded ids spell the normalised text. Columns of the input that
    have one of the new names are left out.
    """
    new = [f.name for f in ADDED]
    names = [c for c in docs.columns if c not in (*new, "text")]

    def run(batches):
        codec = _started(model_path, threads)
        rebuilt = codec.rebuilt
        for batch in batches:
            texts = batch.column("text")
            lengths = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            for first, last in slices(lengths, SLICE_CHARS):
                part = [t or "" for t in texts.slice(first, last - first).to_pylist()]
                lists, replaced, parity = codec.encode(part)
                trips = [rebuilt.decode(ids.tolist()) == _respelled(rebuilt, text) for ids, text in zip(lists, part)]
                sizes = np.array([len(x) for x in lists], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, last - first) for c in names), ids, *map(pa.array, (sizes, replaced, parity, trips))], names=[*names, *new]
                )
            return_memory()

    plain = docs.select(*names, F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, StructType([docs.schema[c] for c in names] + ADDED))


def _respelled(rebuilt: Rebuilt, text: str) -> str:
    normal = rebuilt.normalise(text).replace(MARK, " ")
    return normal[1:] if rebuilt.model.dummy_prefix else normal


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """The rows with ``text`` in place of ``ids``; null ids give an empty text."""
    names = [c for c in rows.columns if c not in ("ids", "text")]

    def run(batches):
        codec = _started(model_path, 1)
        for batch in batches:
            texts = [codec.rebuilt.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, "text"])

    schema = StructType([rows.schema[c] for c in names]).add("text", "string")
    return rows.select(*names, "ids").mapInArrow(run, schema)
