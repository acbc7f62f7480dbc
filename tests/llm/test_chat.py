"""Chat formatting against the plain definition, read back from the output."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from odskein.llm import chat
from tests.llm.samples import prose

TURNS = "conv_id long, turn long, role string, text string, part long, spans string"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def turns():
    rows = [
        (1, 0, "user", "hello\nthere"),
        (1, 1, "assistant", " spaced answer \U0001f600é "),
        (1, 2, "user", None),
        (1, 3, "assistant", "second"),
        (2, 0, "assistant", ""),
        (2, 1, "assistant", None),
        (3, 0, "user", "alone"),
        (4, 1, "assistant", "tie b"),
        (4, 1, "assistant", "tie a"),
        (4, 1, "assistant", "tie a"),
        (4, None, None, "first"),
        (5, 0, "assistant", prose(4000, 1)),
        (5, 1, "<|says|>assistant", "x"),
        (None, 0, "assistant", "nobody's"),
        (None, 0, "user", "nobody's"),
    ]
    nasty = [*chat.CONTROLS, chat.SIGN, f"{chat.SIGN}i", f"<{chat.SIGN}i|turn|>", "<<s>", "[[INST]]", "</s>[INST] ok [/INST]", "<|turn|>user<|says|>x<|done|>"]
    rows += [(100 + i, t, "assistant" if t else "user", text) for i, text in enumerate(nasty) for t in (0, 1)]
    return [(*r, 9, "x") for r in rows]


def expected(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        said = "".join(text for role, text in own if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in own)
        out[conv] = (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part_chars", [1_000_000, 10])
def test_digests_match(spark, monkeypatch, part_chars):
    monkeypatch.setattr(chat, "PART_CHARS", part_chars)
    rows = turns()
    parts = chat.formatted(spark.createDataFrame(rows, TURNS).repartition(3), TOKENIZER)
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(parts).collect()}
    assert found == expected(rows)


def test_one_conversation_over_many_tasks(spark):
    rows = [(1, i // 7, "assistant" if i % 2 else "user", f"turn {i}", 0, "") for i in range(700)] + [(2, 0, "user", "x", 0, "")]
    parts = chat.formatted(spark.createDataFrame(rows, TURNS).repartition(4), TOKENIZER, ranges=5)
    assert parts.where("conv_id = 1").count() > 1
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(parts).collect()}
    assert found == expected(rows)


def test_ids_and_mask(spark):
    from tokenizers import Tokenizer

    row = chat.formatted(spark.createDataFrame(turns(), TURNS).where("conv_id = 1"), TOKENIZER).first()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.add_special_tokens([chat.TURN, chat.SAYS, chat.DONE])
    assert tokenizer.encode(row["formatted"], add_special_tokens=False).ids == row["ids"]
    masked = tokenizer.decode([i for i, m in zip(row["ids"], row["loss"]) if m])
    assert masked == " spaced answer \U0001f600é second"


def test_escape_is_reversible_and_leaves_no_control():
    for text in [r[3] or "" for r in turns()]:
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(control in escaped for control in chat.CONTROLS)


def test_spans_between_tokens():
    mask, covered = chat.loss_tokens(np.array([(0, 2), (2, 5), (5, 5), (5, 9)]), [(2, 5), (7, 8)])
    assert mask.tolist() == [False, True, False, True] and covered == [(2, 5), (5, 9)]


def test_no_rows(spark):
    parts = chat.formatted(spark.createDataFrame([], TURNS), TOKENIZER)
    assert chat.digests(parts).count() == 0


def test_a_token_over_an_edge_is_seen():
    """A token that reaches out of a turn's text covers more than the span."""
    offsets = np.array([(0, 3), (3, 12), (12, 15)])
    mask, covered = chat.loss_tokens(offsets, [(5, 10)])
    assert mask.tolist() == [False, True, False] and covered == [(3, 12)]
    mask, covered = chat.loss_tokens(offsets, [(3, 12)])
    assert covered == [(3, 12)]


def test_digests_read_the_mask(spark):
    rows = [(1, 0, "user", "ask", 0, ""), (1, 1, "assistant", "tell", 0, "")]
    parts = chat.formatted(spark.createDataFrame(rows, TURNS), TOKENIZER)
    unmasked = parts.withColumn("loss", F.transform("loss", lambda _: F.lit(False)))
    assert [r["loss_chars"] for r in chat.digests(parts).collect()] == [4]
    assert [r["loss_chars"] for r in chat.digests(unmasked).collect()] == [0]


def test_marks_that_are_no_tokens_are_crossed(monkeypatch):
    """Marks that are no tokens of their own let others cross a turn's edge."""
    monkeypatch.setattr(chat, "DONE", "ked<|done|>")
    text, spans = chat.render([("assistant", "wal")])
    tokenizer = Tokenizer.from_file(TOKENIZER)
    offsets = np.array(tokenizer.encode(text, add_special_tokens=False).offsets).reshape(-1, 2)
    assert chat.loss_tokens(offsets, spans)[1] != spans
