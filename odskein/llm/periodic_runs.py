"""Periodic runs of words, found by uniting suffix classes in the order of falling common prefixes.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at
least ``least_words`` long and at least ``repeats`` periods, that no neighbouring word extends.

Each text's word suffixes are sorted by prefix doubling. Neighbours in that order are edges whose
weight is their common prefix (LCP). Taken by falling weight, as Kruskal's algorithm takes them, the
edges unite classes of suffixes; a class keeps its positions in order. When two classes with LCP l
unite, positions that become neighbours at a distance d <= l start with the same d words, so they
seed a run of period d that covers the first position up to l words after the second. The first
position is the run's start if the word in front of it breaks the period.

Why each run is seeded once and right: the run's first position s and s + q have LCP length - q,
and nothing between them shares that much, or a smaller period would hold. A seed with a distance
that is no smallest period cannot arise: a position of the smaller period between the two has a
longer LCP with the first, so it stands between them already.

Words met fewer than ``repeats`` times in a text are in no run, so stretches between them are
sorted on their own; suffixes that share fewer words than the shortest run needs are never united.

Defined results: a null or empty text, or one of white space, has no words and no runs, and its
collapsed text is empty; documents are taken row by row, so repeated rows and ids give a result
each; an empty table gives no rows; other columns of the input are not looked at, whatever their names.
A task holds one slice of texts at a time (``SLICE_CHARS``), or one text where it alone is longer.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.llm.native import let, spaced_words, whole_text
from odskein.llm.shared import return_memory
from odskein.llm.token_files import Numbered, slices

LEAST_WORDS = 6
REPEATS = 4
# Positions in one piece of an ordered set; a full piece is halved.
PIECE = 1024

RUN = "struct<start: bigint, length: bigint, period: bigint>"
RUNS_SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Positions:
    """An ordered set of positions in pieces of bounded size."""

    __slots__ = ("pieces", "tops", "size")

    def __init__(self, first: int):
        self.pieces, self.tops, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for piece in self.pieces:
            yield from piece

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Add a new position; the members next to it."""
        pieces, tops = self.pieces, self.tops
        self.size += 1
        k = bisect_left(tops, x)
        if k == len(tops):
            before, after, k = tops[-1], None, k - 1
            piece = pieces[k]
            piece.append(x)
            tops[k] = x
        else:
            piece = pieces[k]
            i = bisect_left(piece, x)
            after = piece[i]
            before = piece[i - 1] if i else tops[k - 1] if k else None
            piece.insert(i, x)
        if len(piece) > PIECE:
            half = len(piece) // 2
            pieces[k : k + 1] = [piece[:half], piece[half:]]
            tops.insert(k, piece[half - 1])
        return before, after


def numbered(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, the number of each word, and the texts' first places in these numbers.

    Words of different texts have different numbers, and behind each text stands a number of its own.
    """
    words = [text.encode("utf-8").split() for text in texts]
    flat, starts, base, at = [], [], 0, 0
    for listed in words:
        own = Numbered()
        ids = np.fromiter(map(own.__getitem__, listed), np.int64, len(listed)) + base
        base += len(own) + 1
        flat += [ids, np.array([base - 1])]
        starts.append(at)
        at += len(listed) + 1
    return words, np.concatenate(flat) if flat else np.empty(0, np.int64), np.array(starts, np.int64)


def edges(ids: np.ndarray, repeats: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes next to each other in sorted order that share at least ``least`` words, and how many.

    A number that occurs fewer than ``repeats`` times is one that nothing else equals.
    """
    n = len(ids)
    counts = np.bincount(ids)
    rank = (np.cumsum(counts) - counts)[ids]  # how many suffixes are smaller than the whole class
    rare = counts[ids] < repeats
    ordered = np.argsort(ids, kind="stable")
    rank[ordered[rare[ordered]]] = np.flatnonzero(rare[ordered])
    open_, levels, width = np.flatnonzero(~rare), [], 1
    while len(open_):
        levels.append(rank.astype(np.int32 if n < 2**31 else np.int64))
        # those that share `width` words, ordered by the words that follow
        key = rank[open_] * (n + 1) + rank[open_ + width]
        order = np.argsort(key, kind="stable")
        members, key = open_[order], key[order]
        opens = np.concatenate([[True], key[1:] != key[:-1]])
        old = rank[members]
        first = np.concatenate([[True], old[1:] != old[:-1]])
        place = np.arange(len(members))
        inside = place - np.maximum.accumulate(np.where(first, place, 0))
        shift = np.maximum.accumulate(np.where(opens, place, 0))
        rank[members] = old + inside[shift]
        alone = opens & np.concatenate([opens[1:], [True]])
        open_, width = np.sort(members[~alone]), 2 * width
    if not levels:
        return (np.empty(0, np.int64),) * 3
    # classes that share fewer words than the largest power of two not above `least` are cut apart
    keep = levels[min(least.bit_length() - 1, len(levels) - 1)]
    place = np.empty(n, np.int64)
    place[rank] = np.arange(n)  # no two ranks are the same any more
    same = np.flatnonzero(keep[place[1:]] == keep[place[:-1]])
    left, right = place[same], place[same + 1]
    shared = np.zeros(len(left), np.int64)
    for level in reversed(range(len(levels))):
        a, b = left + shared, right + shared
        shared += np.where(levels[level][a] == levels[level][b], 1 << level, 0)
    enough = shared >= least
    return left[enough], right[enough], shared[enough]


def periodic_runs(ids: np.ndarray, repeats: int = REPEATS, least_words: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start and period."""
    if repeats < 3:
        raise ValueError("a run has at least three periods")
    # a run of period q has suffixes q apart that share all but q of its words
    least = min(max(least_words, repeats * q) - q for q in range(1, least_words + 1))
    left, right, shared = edges(ids, repeats, least)
    order = np.argsort(-shared, kind="stable")
    places, ends = np.unique(np.concatenate([left[order], right[order]]), return_inverse=True)
    place, words = places.tolist(), ids.tolist() if len(places) else []
    parent = list(range(len(place)))
    classes: list[Positions | None] = [None] * len(place)  # None: the suffix is alone
    found = []

    def root(x: int) -> int:
        while (above := parent[x]) != x:
            parent[x] = x = parent[above]
        return x

    def seed(i: int, j: int, common: int) -> None:
        d = j - i
        if d <= common and d + common >= max(least_words, repeats * d) and (i == 0 or words[i - 1] != words[j - 1]):
            found.append((i, d + common, d))

    for a, b, common in zip(ends[: len(order)].tolist(), ends[len(order) :].tolist(), shared[order].tolist()):
        a, b = root(a), root(b)
        large, small = classes[a], classes[b]
        if small is not None and (large is None or large.size < small.size):
            a, b, large, small = b, a, small, large
        if large is None:
            large = classes[a] = Positions(place[a])
        parent[b], classes[b], last, ahead = a, None, None, None
        for x in (place[b],) if small is None else small:
            if ahead is not None and ahead < x:
                seed(last, ahead, common)
            before, ahead = large.add(x)
            if before is not None and before != last:
                seed(before, x, common)
            last = x
        if ahead is not None:
            seed(last, ahead, common)
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length over period; the first of several, then that with the smallest period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    turns = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        turns[start + period] += 1
        turns[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(turns[:-1]) == 0).tolist()]


def runs_of_texts(texts: list[str], repeats: int = REPEATS, least_words: int = LEAST_WORDS) -> Iterator[tuple]:
    """(words, runs) of each text."""
    words, ids, starts = numbered(texts)
    runs = periodic_runs(ids, repeats, least_words) if len(ids) else []
    owner = np.searchsorted(starts, [run[0] for run in runs], "right") - 1 if runs else []
    of: list[list] = [[] for _ in texts]
    for i, (start, length, period) in zip(owner, runs):
        of[i].append((int(start - starts[i]), length, period))
    return zip(words, of)


def runs(docs: DataFrame, repeats: int = REPEATS, least_words: int = LEAST_WORDS) -> DataFrame:
    """Of every document doc_id, n_words, its runs (by start, then period), the strongest of them, and the collapsed text.

    The collapsed text has the words that no run contains after its first period, one blank between.
    """

    def as_run(run):
        return None if run is None else dict(zip(("start", "length", "period"), run))

    def find(batches):
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for first, last in slices([len(text) for text in texts]):
                results = list(runs_of_texts(texts[first:last], repeats, least_words))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array([len(words) for words, _ in results], pa.int64()),
                        pa.array([[as_run(run) for run in listed] for _, listed in results], pa.list_(_RUN)),
                        pa.array([as_run(strongest(listed)) for _, listed in results], _RUN),
                        pa.array([b" ".join(collapsed_words(words, listed)).decode("utf-8") for words, listed in results], pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "strongest", "collapsed"],
                )
            return_memory()

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(find, RUNS_SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, with a run written into one document of ten, chosen by the checksum of its id."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))

        def word(_, i):
            return F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

        return F.when(n > 0, F.array_join(F.transform(words, word), " ")).otherwise("")

    text = F.when(h % 10 == 0, let(spaced_words(whole_text()), repeated)).otherwise(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and checksums of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(F.lit(1000) * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
