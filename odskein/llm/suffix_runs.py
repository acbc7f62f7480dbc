"""Arrays behind the suffix deduplication: anchors of a text, front-coded runs, and their merge.

A match is a string of LEAST bytes. Each string has an anchor: the place of its GRAM-byte piece with
the smallest hash (the first such). Equal strings have equal anchors, so strings are handled by
anchor: the strings of a text that share an anchor are consecutive and form one *stretch*.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

from odskein.llm.wordhash import mixed, powers, prefix_sums

LEAST = 50
GRAM = 20
SLICE = 1 << 19
_PLACE = np.uint64(SLICE * 2 - 1)


@dataclass
class Stretches:
    """For each stretch: first and last start of its strings, its anchor, the hashes of anchor and stretch."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray
    whole: np.ndarray


def stretches(text: np.ndarray, ends: np.ndarray) -> Stretches:
    """The stretches of a text made of documents that end at ``ends``.

    The text is handled a slice at a time. A slice's edge may cut a stretch in two, which changes
    the way its strings are found, not whether they are.
    """
    parts = [_slice_stretches(text, ends, at) for at in range(0, max(0, len(text) - LEAST + 1), SLICE)]
    if not parts:
        none = np.empty(0, np.int64)
        return Stretches(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Stretches(*(np.concatenate(columns) for columns in zip(*parts)))


def _slice_stretches(text, ends, at):
    data = text[at : at + SLICE + LEAST - 1]
    count = len(data) - LEAST + 1
    sums = prefix_sums(data)
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * powers(len(data))[1][: len(data) - GRAM + 1])
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    wanted = LEAST - GRAM + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    anchor = (least & _PLACE).astype(np.int64)
    inside = np.ones(count, bool)
    low, high = np.searchsorted(ends, [at, at + len(data)], "left")
    near = ends[low : high + 1] - at
    cut = (near[:, None] - np.arange(1, LEAST)).ravel()
    inside[cut[(cut >= 0) & (cut < count)]] = False
    start = np.flatnonzero(inside)
    if not len(start):
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    own = anchor[start]
    turn = np.flatnonzero((np.diff(start) != 1) | (np.diff(own) != 0)) + 1
    first, last = start[np.concatenate([[0], turn])], start[np.concatenate([turn - 1, [len(start) - 1]])]
    own = own[np.concatenate([[0], turn])]
    # the stretch's own hash, apart for each place that the anchor can have in it
    whole = (sums[last + LEAST] - sums[first]) * powers(len(data))[1][first]
    whole = mixed(whole ^ mixed((own - first + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    # anchors have small hashes; mixed anew they fill the buckets evenly
    return first + at, last + at, own + at, mixed(grams[own]), whole


def windows(text: np.ndarray) -> np.ndarray:
    """The string that starts at each place of a text, as rows of bytes (a view)."""
    return np.lib.stride_tricks.sliding_window_view(text, LEAST) if len(text) >= LEAST else np.empty((0, LEAST), np.uint8)


def string_keys(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of the string at each start, a slice of them at a time."""
    keys, texts = np.zeros(len(starts), np.uint64), windows(text)
    for at in range(0, len(starts), SLICE // 8):
        part = slice(at, at + SLICE // 8)
        rows = np.zeros((len(starts[part]), -(-LEAST // 8) * 8), np.uint8)
        rows[:, :LEAST] = texts[starts[part]]
        for column in rows.view(np.uint64).T:
            keys[part] = mixed(keys[part] * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys


# ---------------------------------------------------------------- packed columns


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string."""
    head = np.array([len(arrays), *(part for a in arrays for part in (a.dtype.num, a.nbytes))], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(a.tobytes() for a in arrays))


_KINDS = {np.dtype(t).num: np.dtype(t) for t in (np.uint8, np.int64, np.uint64, np.int32, np.bool_)}


def unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    count = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 1 + 2 * count)[1:].reshape(-1, 2)
    at, out = 8 * (1 + 2 * count), []
    for kind, size in head.tolist():
        dtype = _KINDS[kind]
        out.append(np.frombuffer(data, dtype, size // dtype.itemsize, at))
        at += size
    return out


def differences(values: np.ndarray) -> np.ndarray:
    out = values.copy()
    out[1:] -= values[:-1]
    return out


# ---------------------------------------------------------------- front coding


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (sizes of them) for each range, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - sizes), sizes)


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths (LEAST at most), prefix shared with the string before, and other bytes of sorted strings."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    table = np.frombuffer(b"".join(s.ljust(LEAST, b"\0") for s in strings), np.uint8).reshape(-1, LEAST)
    shared = np.zeros(len(table), np.int64)
    if len(table) > 1:
        differs = table[1:] != table[:-1]
        same = np.where(differs.any(axis=1), differs.argmax(axis=1), LEAST)
        shared[1:] = np.minimum(same, np.minimum(sizes[1:], sizes[:-1]))
    place = np.arange(LEAST)
    rest = table[(place >= shared[:, None]) & (place < sizes[:, None])]
    return sizes.astype(np.uint8), shared.astype(np.uint8), rest


class Run:
    """A sorted run, decoded one string at a time."""

    __slots__ = ("sizes", "shared", "rest", "at", "place", "string")

    def __init__(self, sizes: np.ndarray, shared: np.ndarray, rest: np.ndarray):
        self.sizes, self.shared, self.rest = sizes.tolist(), shared.tolist(), rest.tobytes()
        self.at, self.place, self.string = -1, 0, b""

    def advance(self) -> int:
        """Go to the next string; the prefix it shares with the one before, or -1 at the end."""
        self.at += 1
        if self.at >= len(self.sizes):
            return -1
        shared = self.shared[self.at]
        end = self.place + self.sizes[self.at] - shared
        self.string = self.string[:shared] + self.rest[self.place : end]
        self.place = end
        return shared


def merge(runs: list[Run]):
    """(run, position, shared) in sorted order; shared is the prefix shared with the string before.

    A loser tree whose nodes remember how long a prefix the loser shares with the string that beat
    it. Two strings with different such lengths need no comparison; equal ones are compared from
    that place on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    known = [runs[i].advance() if i < len(runs) else -1 for i in range(size)]

    def play(a: int, la: int, b: int, lb: int):
        """Winner, its length, loser, its length; lengths are about the string put out last."""
        if la != lb:
            return (a, la, b, lb) if la > lb else (b, lb, a, la)
        if la < 0:
            return a, la, b, lb
        x, y = runs[a].string, runs[b].string
        i, end = la, min(len(x), len(y))
        if x[i:end] == y[i:end]:
            i = end
        else:
            while x[i : i + 8] == y[i : i + 8]:  # they differ before the end
                i += 8
            while x[i] == y[i]:
                i += 1
        first = (x[i] < y[i]) if i < end else (len(x), a) < (len(y), b)
        return (a, la, b, i) if first else (b, lb, a, i)

    losers: list = [None] * size
    # Before the first output every known prefix is empty.
    row = [(i, min(known[i], 0)) for i in range(size)]
    while len(row) > 1:
        half = len(row) // 2
        winners = []
        for i in range(half):
            w, lw, x, lx = play(*row[2 * i], *row[2 * i + 1])
            losers[half + i] = (x, lx)
            winners.append((w, lw))
        row = winners
    winner, length = row[0]
    while length >= 0:
        run = runs[winner]
        yield winner, run.at, length
        length = run.advance()
        node = (winner + size) // 2
        while node:
            other, known_length = losers[node]
            if length < known_length:
                losers[node] = (winner, length)
                winner, length = other, known_length
            elif length == known_length and length >= 0:
                winner, length, loser, beaten = play(winner, length, other, known_length)
                losers[node] = (loser, beaten)
            node //= 2
