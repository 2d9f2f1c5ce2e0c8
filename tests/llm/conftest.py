from __future__ import annotations

import pytest

from tarmac.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def odd_documents(spark):
    """Nulls everywhere, empty, very long and repeated texts, ties, and columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    text = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, text, "en", "a"),
        (2, text, "en", "a"),
        (2, text, "en", "a"),
        (3, text + " more", "fr", None),
        (4, None, "en", "a"),
        (5, "", None, "b"),
        (6, "  \t\n ", "en", "b"),
        (7, long, "en", "b"),
        (8, "one two", "fr", "b"),
        (9, "one two", None, "b"),
        (None, "lone row of a null id", "en", None),
        (10, "日本語 テキスト 😀 token=abcdefgh1234", "en", "c"),
        (10, "other text of a repeated id", "en", "c"),
    ]
    extra = [(*r, 1, 2, 3, 4, "x", "y") for r in rows]
    columns = "doc_id long, text string, lang string, source string, n long, row int, spans int, key int, path string, score string"
    return spark.createDataFrame(extra, columns)


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd_pairs(odd_documents):
    return pairs(odd_documents)
