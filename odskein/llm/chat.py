"""Chat formatting: whole conversations as text and token ids, with a loss mask.

A turn is written as ``<|turn|>role<|says|>text<|done|>``. Control strings (these marks, and those of
other formats) are escaped inside roles and texts by an escape sign after their first character,
which can be taken out again. A conversation is rendered whole and encoded once, with offsets; the
marks are tokens of their own, so no other token crosses a turn's edge. The tokens under the loss
mask are found by intersecting the sorted spans of the assistant's texts with the sorted spans of
the tokens by binary search.

Turns are dealt out by ranges of (conv_id, turn), so a very long conversation is spread over tasks
and comes out as several rows (``part`` orders them). A task cuts a conversation also where it
holds ``PART_CHARS`` characters, always between turns, where the marks make a cut harmless.

Defined results: null texts and roles are empty; a null conv_id is a conversation of its own that
sorts first, a null turn sorts first; turns of equal number follow by role and text; repeated rows
are all turns; a conversation without assistant has an empty mask; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>"
# Control strings of this and other formats; fixed values.
CONTROLS = (TURN, SAYS, DONE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")
SIGN = "␛"
_ESCAPED = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))
_TURNS = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SAYS) + "(.*?)" + re.escape(DONE), re.S)
PART_CHARS = 1_000_000
FORMATTED = (
    "conv_id long, part long, n_turns long, formatted string, ids array<int>, loss array<boolean>, begins array<int>, "
    "finishes array<int>, spans array<struct<begin:int,finish:int>>"
)


def escape(text: str) -> str:
    """``text`` without any control string; ``unescape`` gives it back."""
    return _ESCAPED.sub(lambda m: f"{m[0][0]}{SIGN}i{m[0][1:]}", text.replace(SIGN, f"{SIGN}e"))


def unescape(text: str) -> str:
    return text.replace(f"{SIGN}i", "").replace(f"{SIGN}e", SIGN)


def render(turns: list[tuple[str, str]], speaker: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The text of the turns (role, text), and where the speaker's texts stand in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        before, body = f"{TURN}{escape(role)}{SAYS}", escape(text)
        at += len(before)
        if role == speaker and body:
            spans.append((at, at + len(body)))
        parts += [before, body, DONE]
        at += len(body) + len(DONE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    return [(unescape(role), unescape(text)) for role, text in _TURNS.findall(formatted)]


def loss_tokens(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """A mask over tokens with sorted (begin, end) offsets, and the text that the masked tokens cover.

    Where a token reaches over a span's edge, so does the text covered.
    """
    mask = np.zeros(len(offsets), bool)
    covered = []
    for begin, end in spans:
        first = int(np.searchsorted(offsets[:, 1], begin, "right"))
        last = int(np.searchsorted(offsets[:, 0], end, "left"))
        mask[first:last] = True
        if first < last:
            covered.append((int(offsets[first, 0]), int(offsets[last - 1, 1])))
    return mask, covered


def masked_spans(loss: np.ndarray, begins: np.ndarray, finishes: np.ndarray) -> list[tuple[int, int]]:
    """Where the text of the masked tokens stands: one span for each run of them."""
    turns = np.flatnonzero(np.diff(loss.astype(np.int8), prepend=0, append=0))
    return [(int(begins[a]), int(finishes[b - 1])) for a, b in zip(turns[::2], turns[1::2])]


def formatted(turns: DataFrame, tokenizer_path: str, speaker: str = "assistant", ranges: int | None = None) -> DataFrame:
    """One row for each conversation (or part of a long one).

    It has the text, the token ids, for each token whether it is under the loss mask and where in the text
    it begins and finishes, and the spans of the text that the mask is meant to cover.

    ``ranges`` fixes the number of tasks; by default Spark chooses it.
    """

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext
        from tokenizers import AddedToken, Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.add_special_tokens([AddedToken(mark, special=True, normalized=False) for mark in (TURN, SAYS, DONE)])
        part = TaskContext.get().partitionId() << 32

        def row(conv_id, held):
            text, spans = render(held, speaker)
            encoded = tokenizer.encode(text, add_special_tokens=False)
            offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
            mask, covered = loss_tokens(offsets, spans)
            if covered != spans:
                raise ValueError(f"tokens of conversation {conv_id} cross a turn's edge")
            return conv_id, part, len(held), text, np.array(encoded.ids, np.int32), mask, *offsets.T.astype(np.int32), spans

        conv_id, held, size = None, [], 0
        for batch in batches:
            out = []
            for at, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if held and (at != conv_id or size >= PART_CHARS):
                    out.append(row(conv_id, held))
                    part, held, size = part + 1, [], 0
                conv_id = at
                held.append((role, text))
                size += len(text)
            yield from _batch(out)
        if held:
            yield from _batch([row(conv_id, held)])

    empty = F.lit("")
    key = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "row")]
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return plain.repartitionByRange(*([ranges] if ranges else []), *key).sortWithinPartitions(*key).mapInArrow(run, FORMATTED)


def _batch(rows):
    if rows:
        conv, part, n, text, ids, loss, begins, finishes, spans = zip(*rows)
        ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
        span = pa.struct([("begin", pa.int32()), ("finish", pa.int32())])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(conv, pa.int64()),
                pa.array(part, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(text, pa.string()),
                *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(column))) for column in (ids, loss, begins, finishes)),
                pa.array([[{"begin": a, "finish": b} for a, b in s] for s in spans], pa.list_(span)),
            ],
            names=["conv_id", "part", "n_turns", "formatted", "ids", "loss", "begins", "finishes", "spans"],
        )


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(parts: DataFrame) -> DataFrame:
    """What the formatted text of each conversation says, read back from it: one row for each.

    Turns are parsed from the text; the text to learn from is that of the tokens under the mask. A digest is made front to back, so a conversation's parts are hashed by one task, one at a time.
    """

    def run(batches):
        conv_id = state = None

        def done():
            n, turns, chars, loss, length = state
            return conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), length

        for batch in batches:
            out = []
            lists = [batch.column(c) for c in ("loss", "begins", "finishes")]
            edges = lists[0].offsets.to_numpy()
            flat = [column.values.to_numpy(zero_copy_only=False) for column in lists]
            for i, (at, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted")))):
                tokens = [values[edges[i] : edges[i + 1]] for values in flat]
                if state is None or at != conv_id:
                    if state is not None:
                        out.append(done())
                    conv_id, state = at, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                for begin, finish in masked_spans(*tokens):
                    said = unescape(text[begin:finish])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "replace"))
                state[4] += len(text)
            yield from _digest_batch(out)
        if state is not None:
            yield from _digest_batch([done()])

    key = [F.col("conv_id").asc_nulls_first(), F.col("part").asc()]
    ordered = parts.select("conv_id", "part", "formatted", "loss", "begins", "finishes").repartition("conv_id").sortWithinPartitions(*key)
    return ordered.mapInArrow(run, DIGESTS)


def _digest_batch(rows):
    if rows:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = [column.split()[0] for column in DIGESTS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
