"""Rows for the tests: nulls, empty and long texts, copies, clashing column names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, score double, kept boolean, `a.b` string"


def prose(seed: int, words: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(words))


def rows_of(texts: list) -> list[tuple]:
    return [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), 7, 0.5, True, "x") for i, t in texts]


EDGES = [
    (1, prose(1)),
    (2, prose(1)),  # a copy
    (2, prose(1)),  # a repeated row
    (3, prose(1) + " tail"),  # a near copy
    (None, prose(1)),  # a copy without an id
    (None, prose(2)),
    (4, None),
    (5, ""),
    (5, ""),
    (6, " \n\t "),
    (7, "one two"),
    (8, "One  TWO"),  # the same short sequence
    (9, "12 34 !!"),
    (10, prose(3, 20_000)),  # very long
    (11, "é漢字 " * 40),
    (12, "x" * 50_000),  # one long word
]
