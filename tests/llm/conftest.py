from __future__ import annotations

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the small folder."""
    return duckdb.connect().execute(f"SELECT doc_id, text FROM read_parquet('{SMALL}/documents.parquet') ORDER BY 1").fetchall()


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(120_000))
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "One two three."),
    (5, "The same text of a few words, and the same line\nagain and again."),
    (6, "The same text of a few words, and the same line\nagain and again."),
    (6, "The same text of a few words, and the same line\nagain and again."),
    (7, LONG),
    (None, "A text without an id, and the same line"),
    (9, "Été ▁ \U0001f600 \x00 nul\n\nthe end"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, repeated and very long texts, a null id, and columns with names the operators use."""
    rows = [(i, t, "en", "s", 0, "x", "y", "z", "u", "v") for i, t in ODD_TEXTS]
    extra = "_text string, rules string, lines string, hits string, coded string"
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
