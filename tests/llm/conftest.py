from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards quietly judge my vow and pack five dozen "
         "liquor jugs into one large box near old mill road where every morning a small train carries coal to town")


def prose(n: int, seed: int = 0) -> str:
    """n words, repeatable, that share no run of words with those of another seed."""
    r = random.Random(seed)
    words = PROSE.split()
    return " ".join(f"{r.choice(words)}{r.randrange(97)}" for _ in range(n))


EDGE_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\r\x0b\x0c ", "en", "a", 7),
    (4, prose(120), "en", "a", 1),
    (5, prose(120), "en", None, 1),          # an exact copy under another id
    (6, prose(90, 3), "en", "b", 1),
    (6, prose(90, 3), "en", "b", 1),         # a repeated row
    (None, prose(80, 5), "de", "b", 1),      # no id
    (8, "Ünï çödé 漢字 текст " * 30, "fr", "c", 1),
    (9, "one two", "en", "c", 7),
    (10, prose(60_000, 9), "en", "c", 1),    # a very long text
    (11, "!!! ### $$$ ... " * 40, "en", "a", 1),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE_ROWS, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing_docs(edge_docs):
    """The edge rows with further columns that are named like outputs and internal columns."""
    names = ("size", "copies", "taken", "target", "kept", "score", "n_words", "k", "band", "task", "c0", "c1", "_k",
             "_copy", "root", "held_out", "is_dup")
    return edge_docs.selectExpr("*", *[f"{i} as `{n}`" for i, n in enumerate(names)])
