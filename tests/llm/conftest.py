from __future__ import annotations

import pytest

ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "a",
    "One two",
    "the same text twice over and over again",
    "the same text twice over and over again",
    "ÀÉ ñandú straße 日本語 текст\x00\x85end",
    "x" * 5_000,
    "lorem ipsum dolor " * 4_000,
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    rows = [(i, text, "en" if i % 2 else None, "s", i, "kept") for i, text in enumerate(ODD_TEXTS)]
    rows += [(None, "a text without an id", "fr", None, None, None), rows[5], (77, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, score int, ids string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
