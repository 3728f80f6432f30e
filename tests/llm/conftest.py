from __future__ import annotations

import pytest

LONG = "long words of one text " * 8000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and names the operators use themselves."""
    rows = [
        (1, "Some words that stand here.\nA second line of them.", "en", "a", 10, "x", 1),
        (1, "Some words that stand here.\nA second line of them.", "en", "a", 10, "x", 1),
        (2, "Some words that stand here.\nA second line of them.", "en", "a", 10, None, 2),
        (3, None, "en", "a", None, "y", 3), (4, "", None, "a", 0, "y", None), (5, "   \n\t", "en", None, 5, "y", 5),
        (None, "A text without an id.", "en", "b", 21, "z", 6), (None, None, None, None, None, None, None),
        (6, LONG, "en", "b", len(LONG), "z", 7), (7, "x" * 50_000, "en", "b", 50_000, "z", 8),
        (8, "é ü 中文 \U0001f600 \u0000 ​", "fr", "c", 12, "z", 9), (9, "one", "en", "c", 3, "z", 10),
        (10, "\n".join(["line"] * 3000), "en", "c", 1, "z", 11),
    ]
    kind = "doc_id long, text string, lang string, source string, n_chars long, tokens string, deleted int"
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
