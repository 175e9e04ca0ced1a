"""Small tables of hard rows, shared by the tests of the subpackage."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block long, spans string, n int"


def rows(texts, start: int = 0):
    """Rows of ``documents`` with three further columns whose names operators use."""
    return [(start + i, t, "en", "src0", None if t is None else len(t), i, "x", 1) for i, t in enumerate(texts)]


def sentence(rng: random.Random, n: int, vocabulary: int = 300) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


HARD = [
    None,
    "",
    " \t\n ",
    "one",
    "two words",
    "日本語 のテキスト 😀😀",
    "é" * 400,
    "a  b   c\n\n\td ▁ e",
    "x" * 3000,
    "the the the the the the the the the the",
    "<s> </s> <|endoftext|> <0x41>",
]


@pytest.fixture(scope="session")
def hard(spark):
    """Null ids and texts, an empty and a very long text, ties and repeated rows."""
    rng = random.Random(11)
    texts = HARD + [sentence(rng, k) for k in (19, 20, 60, 200, 5000)]
    own = rows(texts)
    own += [own[12], own[12], (None, *own[13][1:]), (None, *own[13][1:]), (3, *own[14][1:])]
    return spark.createDataFrame(own, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
