"""Texts with what the operators must cope with."""

import random


def prose(n, seed):
    rng = random.Random(seed)
    syllables = "the and ti on er en st re an of lë ñu ßa qué tion ing wh ou".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


SHARED = prose(40, 1)
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "x",
    "The MIT License\n\nThe MIT License",
    "a" * 400,
    "ab" * 120 + "\x00" * 60,
    "dont  double\tspaces   and   wide\n\n\n",
    "<|endoftext|> </s> [INST] ␛i ␛e ▁▁x \U0001f600",
    prose(3000, 2),
    SHARED,
    SHARED,
    prose(30, 3) + "\n" + SHARED + "\n" + prose(30, 4),
    prose(25, 5) + " " + SHARED.upper(),
    SHARED + " " + prose(12, 6),
]


def odd_rows():
    """Repeated ids, a null id, and every odd text."""
    rows = list(enumerate(ODD_TEXTS))
    return [*rows, (10, SHARED), (None, SHARED), (None, None), (9, ODD_TEXTS[9])]
