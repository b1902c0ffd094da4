"""Fixtures of the parent folder; rows that every operator has to take."""

from __future__ import annotations

import pytest

#: doc_id, text, lang, source: NULLs, empty and blank texts, ties, repeated rows, one long text.
ODD_DOCS = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \t\n\x0b\x0c\r", "en", "a"),
    (4, "One two three four five six seven", "en", None),
    (4, "One two three four five six seven", "en", None),
    (5, "one TWO three four five six seven", "de", "b"),
    (None, "one two three four five six seven", None, "b"),
    (6, "é日本 x", "fr", "c"),
    (7, "word " * 40_000, "en", "a"),
    (8, "123 !!! 456", "en", "a"),
    (9, "x", "en", "b"),
]
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_DOCS, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(spark):
    """Columns named like those that the operators make."""
    names = ["n", "fp", "keys", "key", "h", "size", "sid", "score", "label", "bucket", "component", "x", "taken", "start"]
    rows = [(i, t, lang, s, *range(len(names))) for i, t, lang, s in ODD_DOCS]
    return spark.createDataFrame(rows, DOC_SCHEMA + "".join(f", {n} bigint" for n in names))
