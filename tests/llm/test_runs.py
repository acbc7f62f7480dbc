"""Periodic runs against all stretches of all periods."""

import hashlib
import random
import zlib

import pytest

from odskein.llm import periodic_runs
from odskein.llm.periodic_runs import Positions, planted, run_digests, runs, runs_of_texts
from tests.llm.samples import odd_rows, prose


def brute(words, repeats=4, least=6):
    """All maximal stretches of every period, each with its smallest one."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q - i), q)  # a longer period of the same stretch comes later
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def written(doc_id, text):
    """The words of a text with the run written into one document of ten."""
    words = (text or "").encode().split()
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digest(doc_id, text):
    words = written(doc_id, text)
    listed = brute(words)
    best = max(listed, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    dropped = {i for s, length, q in listed for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in listed)
    return (
        doc_id,
        len(listed),
        *(best or (None,) * 3),
        None if best is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def test_random_words_of_small_alphabets():
    rng = random.Random(3)
    texts = []
    for _ in range(400):
        letters = "abcdef"[: rng.randint(1, 6)]
        words = rng.choices(letters, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            piece = rng.choices(letters, k=rng.randint(1, 9))
            at = rng.randint(0, len(words))
            words[at:at] = (piece * 9)[: rng.randint(len(piece), 9 * len(piece))]
        texts.append(" ".join(words))
    for text, (words, found) in zip(texts, runs_of_texts(texts)):
        assert found == brute(words), text


@pytest.mark.parametrize("repeats, least", [(3, 3), (4, 6), (5, 20)])
def test_other_bounds(repeats, least):
    rng = random.Random(repeats)
    texts = [" ".join("".join(rng.choices("ab", k=1)) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    for text, (words, found) in zip(texts, runs_of_texts(texts, repeats, least)):
        assert found == brute(words, repeats, least), text


def test_ordered_positions(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PIECE", 4)
    rng = random.Random(5)
    values = rng.sample(range(1000), 300)
    held = Positions(values[0])
    for n, x in enumerate(values[1:], 1):
        before = max((v for v in values[:n] if v < x), default=None)
        after = min((v for v in values[:n] if v > x), default=None)
        assert held.add(x) == (before, after)
    assert list(held) == sorted(values) and held.size == 300


def test_long_texts_of_one_word_and_of_long_periods():
    piece = prose(900, 8)
    texts = ["a " * 60_000, " ".join([piece] * 12), prose(20_000, 4)]
    found = [listed for _, listed in runs_of_texts(texts)]
    assert found[0] == [(0, 60_000, 1)]
    assert found[1][0] == (0, 10_800, 900)


def test_documents(spark, docs_of):
    rng = random.Random(9)
    rows = [*odd_rows(), *((100 + i, prose(rng.randint(1, 80), i)) for i in range(150))]
    rows += [(400, "x y " * 30 + "x"), (401, "x " * 5), (402, "x " * 6), (403, "A a " * 4), (403, "a\x0ba\x0ca\ra\ta\na\xa0a a")]
    docs = docs_of(rows).withColumnRenamed("lang", "runs").withColumnRenamed("source", "n_words")
    found = run_digests(runs(planted(docs)))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((digest(*row) for row in rows), key=repr)
    assert any(row["n_runs"] for row in found.collect())


def test_empty_table(spark, docs_of):
    assert run_digests(runs(planted(docs_of([]).limit(0)))).collect() == []
