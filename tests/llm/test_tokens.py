"""Token files and the piece codec against the libraries themselves."""

import json
import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as messages
from tokenizers import Tokenizer

from odskein.llm import piece_codec, token_files
from odskein.llm.shared import new_path
from tests.llm.samples import ODD_TEXTS, odd_rows, prose

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPACES = ["a  b", "a \nb", "\n\nfoo", "foo\n\n\nbar baz\n", "tab\there \t x", "nb\xa0sp \xa0x y", "　x   y", " lead", "trail ", "x\r\ny", "don't we'll", "\n", " ", "\n ", "1 22 333", "a.b, c..\n.d"]


@pytest.mark.parametrize("remembered", [5, 800_000])
def test_words_give_the_texts_ids(monkeypatch, remembered):
    monkeypatch.setattr(token_files, "KNOWN_PIECES", remembered)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    encoder = token_files.WordEncoder(tokenizer)
    rng = random.Random(1)
    texts = [t or "" for t in ODD_TEXTS] + SPACES + ["".join(rng.choices("ab \n\té.' ", k=30)) for _ in range(300)]
    for at in range(0, len(texts), 9):
        part = texts[at : at + 9]
        ids, counts = encoder.encode(part)
        found = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in part]


@pytest.mark.parametrize("delta", [False, True])
def test_files_in_order(spark, docs_of, delta):
    rows = [*odd_rows(), *((100 + i, prose(50, i)) for i in range(60))]
    path = new_path(spark, "tokens")
    token_files.write_token_files(docs_of(rows).withColumnRenamed("lang", "ids"), path, BYTE_BPE, end_id=0, row_group_bytes=4096, page_rows=10, delta=delta)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    counts, sums = {}, {}
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        counts.setdefault(doc_id, []).append(len(ids))
        sums.setdefault(doc_id, []).append(zlib.crc32(ids.tobytes()))
    found = token_files.id_digests(spark, path).orderBy("start").collect()
    at = 0
    for row in found:
        assert row["start"] == at and row["n_tokens"] in counts[row["doc_id"]] and row["ids_crc32"] in sums[row["doc_id"]]
        at += row["n_tokens"]
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(ids) == len(rows)
    starts = token_files.token_starts(spark, path).collect()
    assert sorted((r["start"], r["n_tokens"]) for r in starts) == sorted((r["start"], r["n_tokens"]) for r in found)


def test_starts_with_several_files_a_task(spark, docs_of, monkeypatch):
    """Starts follow the files' order also where another writer's setting splits a task's rows."""
    docs = docs_of([(i, prose(20, i)) for i in range(200)])
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "20")
    try:
        whole, split = new_path(spark, "tokens"), new_path(spark, "tokens")
        token_files.write_token_files(docs, whole, BYTE_BPE)
        assert len(token_files.read_token_files(spark, whole).inputFiles()) < 10
        token_files.read_token_files(spark, whole).orderBy("doc_id").coalesce(1).write.parquet(split)
        assert len(token_files.read_token_files(spark, split).inputFiles()) == 10
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", before)
    for path in (whole, split):
        at = 0
        for row in token_files.id_digests(spark, path).orderBy("doc_id").collect():
            assert row["start"] == at
            at += row["n_tokens"]


def test_pieces_with_one_hash_are_told_apart(monkeypatch):
    """With a hash of two values nearly all pieces meet another one's hash."""
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    monkeypatch.setattr(token_files, "mixed", lambda values: values & np.uint64(1))
    encoder = token_files.WordEncoder(tokenizer)
    for text in (prose(200, 1), prose(200, 2), "a b a c", ""):
        ids, counts = encoder.encode([text, text])
        assert ids.tolist() == 2 * tokenizer.encode(text, add_special_tokens=False).ids
        assert counts[0] == counts[1]


def test_plain_words_go_to_the_model_itself():
    """No word of letters passes through the whole tokenizer, whatever marks stand behind it."""
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    encoder = token_files.WordEncoder(tokenizer)
    said = []

    def whole(texts, **options):
        said.extend(texts)
        return tokenizer.encode_batch_fast(texts, **options)

    encoder.tokenizer = SimpleNamespace(encode_batch_fast=whole)
    text = "Zebra zebra, zebra. été été, Ночь ночь;\nzebra!\nnew (zebra)"
    ids, _ = encoder.encode([text])
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(said) == sorted([",", ".", "!", ")", " (zebra"])


@pytest.mark.parametrize("known_pattern", [True, False])
def test_letters_and_marks_of_all_kinds(known_pattern):
    with open(BYTE_BPE) as file:
        said = json.load(file)
    said["model"]["ignore_merges"] = not known_pattern
    tokenizer = Tokenizer.from_str(json.dumps(said))
    encoder = token_files.WordEncoder(tokenizer)
    assert (encoder.model is not None) == known_pattern
    rng = random.Random(2)
    texts = ["".join(rng.choices("aBst'`.,|  \n\t1é×÷ÿǅʰЯҀ҂ª٣\u3000\xa0“ა中", k=25)) for _ in range(2_000)]
    texts += ["don't", "we'll've", "rock'n'roll's.", "x''s", "\n'tis", " \nword", "\n\nword", "a" * 3_000 + ",", "Ã\x97"]
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        ids, counts = encoder.encode(part)
        found = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in part]


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 50)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    texts = [prose(300, 1), "x" * 400, prose(30, 2) + "\n" * 200 + "ü" * 90]
    ids, counts = token_files.WordEncoder(tokenizer).encode(texts)
    found = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_selective_reads(spark, docs_of):
    path = new_path(spark, "tokens")
    token_files.write_token_files(docs_of([(i, prose(200, i)) for i in range(100)]).coalesce(1), path, BYTE_BPE, row_group_bytes=20_000)
    import glob

    files = glob.glob(f"{path}/part-*.parquet")
    metadata = [pq.ParquetFile(f).metadata for f in files]
    column = metadata[0].row_group(0).column(0)
    assert column.has_offset_index and column.has_column_index
    frame = token_files.read_token_files(spark, path).where("doc_id = 42").select("n_tokens")
    shown = frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,42)" in shown and "ids" not in shown.split("ReadSchema")[1]


def test_no_documents(spark, docs_of):
    path = new_path(spark, "tokens")
    token_files.write_token_files(docs_of([]), path, BYTE_BPE)
    assert token_files.id_digests(spark, path).count() == 0
    assert piece_codec.encoded(docs_of([]), PIECES).count() == 0


# ---------------------------------------------------------------- pieces


def unigram_model(byte_fallback, strip=True, prefix=True, seed=0):
    """A small unigram model, put together by hand."""
    model = messages.ModelProto()

    def add(piece, score, kind):
        entry = model.pieces.add()
        entry.piece, entry.score, entry.type = piece, score, kind

    add("<unk>", 0, 2)
    add("<s>", 0, 3)
    if byte_fallback:
        for i in range(256):
            add(f"<0x{i:02X}>", 0, 6)
    rng = random.Random(seed)
    mark = piece_codec.MARK
    syllables = "the and ti on er en st re an of tion ing wh ou".split()
    pieces = dict.fromkeys([mark, *"abcdefghijklmnopqrstuvwxy.,", *syllables, *(mark + s for s in syllables), mark * 2])
    for piece in pieces:
        add(piece, round(-rng.uniform(1, 9) - (6 if len(piece) == 1 else 0), 3), 1)
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = byte_fallback
    model.trainer_spec.unk_id = 0
    model.normalizer_spec.add_dummy_prefix = prefix
    model.normalizer_spec.remove_extra_whitespaces = strip
    model.normalizer_spec.escape_whitespaces = True
    return model.SerializeToString()


def texts():
    return [t or "" for t in ODD_TEXTS] + SPACES + ["  the  ", "zebra <0x41> <s> </s> <unk>", "▁the▁ and"]


@pytest.mark.parametrize(
    "data",
    [open(PIECES, "rb").read(), unigram_model(True), unigram_model(False), unigram_model(True, strip=False), unigram_model(True, prefix=False)],
    ids=["bpe", "unigram", "no-bytes", "all-spaces", "no-prefix"],
)
def test_parity_with_the_models_own_library(data):
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = piece_codec.Codec(data)
    lists, replaced, parity = codec.encode(texts())
    assert [x.tolist() for x in lists] == [own.encode(t) for t in texts()]
    assert all(parity)
    plain = [i for i, t in enumerate(texts()) if "▁" not in t and "<" not in t]
    assert sum(replaced[i] for i in plain) <= len(plain)


def test_parity_vouches_for_every_text(monkeypatch):
    codec = piece_codec.Codec(open(PIECES, "rb").read())
    normalise = codec.rebuilt.normalise
    monkeypatch.setattr(codec.rebuilt, "normalise", lambda text: normalise(text).replace("ou", "uo"))
    said = [f"you and house {i}" if i % 2 else f"the end {i}" for i in range(100)]
    lists, _, parity = codec.encode(said)
    assert parity == [i % 2 == 0 for i in range(100)]
    assert [x.tolist() for x in lists] == [codec.own.encode(t) for t in said]


def test_word_by_word_needs_little_help():
    codec = piece_codec.Codec(open(PIECES, "rb").read())
    _, replaced, _ = codec.encode([prose(500, i) for i in range(5)])
    assert replaced.sum() == 0


def test_model_is_read_as_the_library_reads_it():
    data = open(PIECES, "rb").read()
    model, message = piece_codec.read_model(data), messages.ModelProto()
    message.ParseFromString(data)
    assert [(p, s, k) for p, s, k in model.pieces] == [(p.piece, p.score, p.type) for p in message.pieces]
    assert model.kind == message.trainer_spec.model_type and model.byte_fallback == message.trainer_spec.byte_fallback
    assert model.dummy_prefix == message.normalizer_spec.add_dummy_prefix


def test_round_trip(docs_of):
    docs = docs_of(odd_rows()).withColumnRenamed("lang", "ids").withColumnRenamed("source", "parity")
    rows = piece_codec.encoded(docs, PIECES)
    assert rows.columns == ["doc_id", "n_chars", "ids", "n_tokens", "n_replaced", "parity", "round_trip"]
    assert all(r["round_trip"] and r["parity"] and r["n_tokens"] == len(r["ids"]) for r in rows.collect())
    back = piece_codec.decoded(rows, PIECES)
    expected = sorted((repr(i), (t or "").replace("▁", " ")) for i, t in odd_rows())
    assert sorted((repr(r["doc_id"]), r["text"]) for r in back.collect()) == expected


def test_broken_bytes_decode_to_replacement(spark):
    rows = spark.createDataFrame([(1, [3 + 0xFF, 3 + 0x41]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in piece_codec.decoded(rows, PIECES).collect()} == {1: "�A", 2: "", 3: ""}


def test_words_are_learnt_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(piece_codec, "FRESH_WORDS", 3)
    with open(PIECES, "rb") as file:
        codec = piece_codec.Codec(file.read())
    most, through = [], codec.rebuilt.encode_words
    monkeypatch.setattr(codec.rebuilt, "encode_words", lambda words: most.append(len(words)) or through(words))
    texts = [prose(40, seed) for seed in range(4)] + [text or "" for text in ODD_TEXTS]
    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for part in (texts[:3], texts, []):
        lists, _, _ = codec.encode(part)
        assert [x.tolist() for x in lists] == [own.encode(text) for text in part]
    assert max(most) == 3 and codec.count == len(codec.known)
