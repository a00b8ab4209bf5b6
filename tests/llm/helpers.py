"""Small tables for the operators' tests."""

from __future__ import annotations

import random

WORDS = [a + b + c for a in ("ka", "lo", "mi", "ne", "su", "ti") for b in ("ra", "bo", "de", "fi", "gu") for c in ("n", "s", "l", "")]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, component string, id string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 12]) for i in range(0, n, 12))


def documents(spark, rows):
    """Documents of (doc_id, text, lang, source) with more columns, some with names that operators use inside."""
    return spark.createDataFrame([(i, t, la, so, None if t is None else len(t), "x", "y", "z", "w") for i, t, la, so in rows], SCHEMA)


#: Nulls in every column, empty and long texts, repeated rows and ids.
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (None, "some words here", None, None), (3, " \n\t ", None, "a"),
    (4, "same text twice", "en", None), (4, "same text twice", "en", None), (4, "other text of this id", "de", "b"),
    (5, "x" * 30_000, "en", "b"), (6, prose(1, 9_000), "en", "b"), (7, "<|endoftext|> ¿qué? 漢字 ՘", "es", "ä"),
    (None, None, None, None), (8, "#$%&|", "en", "b"),
]


def odd(spark):
    return documents(spark, ODD)


def empty(spark):
    return documents(spark, [])
