"""Words of letters and digits in UTF-8 bytes, and hashes of words and shingles, by whole arrays.

The hash of a word is a polynomial of its bytes modulo 2**64, read off the prefix sums of the whole
buffer. It finds candidates only; whoever uses it compares the words themselves afterwards.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
BLANK = 32
# A-Z in lower case, other ASCII that is no letter or digit as a blank.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else BLANK for c in range(256)
)
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**64, 256, dtype=np.uint64)
_powers = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def words_of(text: bytes) -> bytes:
    """The text with words kept, A-Z lower-cased, and a blank for every other byte."""
    return text.translate(_WORDS)


def spell(part: bytes) -> str:
    """The words of a part, with one blank between them."""
    return b" ".join(part.split()).decode("utf-8")


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2**64, for i below count."""
    if len(_powers[0]) < count:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(count, base, np.uint64)
            steps[:1] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:count], _powers[1][:count]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of value * BASE ** place over the bytes before each place (one more than there are bytes)."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * powers(len(data))[0], out=sums[1:])
    return sums


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a buffer that ends in a blank."""
    blank = np.concatenate([[True], data == BLANK])
    turns = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = turns[::2], turns[1::2]
    sums = prefix_sums(data)
    return starts, ends, mixed((sums[ends] - sums[starts]) * powers(len(data))[1][starts])


def hash_shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    count = max(0, len(hashes) - k + 1)
    out = hashes[:count].copy()
    for i in range(1, k):
        out = mixed(out * np.uint64(0x2545F4914F6CDD1D) + hashes[i : i + count])
    return out
