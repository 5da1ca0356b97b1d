"""Fixtures of the text-preparation tests; the session is the one of the other tests."""

import pytest

from clicklens.llm.common import ship

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def lspark(spark):
    ship(spark)
    return spark


@pytest.fixture
def odd_docs(lspark):
    """Nulls in every column, empty texts, ties, repeated rows, and extra columns with clashing names."""
    long_text = "lorem ipsum dolor " * 40_000
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1, "x", 0.5),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1, "x", 0.5),
        (2, "", "en", "a", 0, None, None),
        (3, None, None, None, None, None, None),
        (None, "a text without an id", "en", "b", 3, "y", 1.0),
        (None, None, None, "b", None, None, None),
        (4, " \t\n ", "de", None, 4, "z", 2.0),
        (5, "123 456 !!", "de", "c", 4, "z", 2.0),
        (6, "ein Satz mit Wörtern, die es gibt", "de", "c", 4, "z", 2.0),
        (7, long_text, "en", "c", len(long_text), "z", 2.0),
    ]
    names = f"{DOCS}, size string, score double, spans int, row int, key int, th int, group int, shard int, base int"
    return lspark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows], names)


@pytest.fixture
def no_docs(lspark):
    return lspark.createDataFrame([], DOCS)
