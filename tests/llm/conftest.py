from __future__ import annotations

import zlib

import pytest

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def fold(doc_id, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like inner ones."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "one two three four five six", "en", "a", 1),
        (1, "one two three four five six", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "de", None, 0),
        (4, "\n \t\n", "de", "b", 4),
        (5, long, "en", "b", len(long)),
        (6, long + " end", None, "b", None),
        (7, "ünïcödé 𝒳 語   x", "fr", "a", 1),
        (None, "no id at all here", "en", "a", 1),
        (8, "12 + 34 = 46 !!", "en", None, 1),
    ]
    shape = SHAPE + ", _text string, _id long, n_lines long, size string, score string, _own int, `a.b` string, `c``d` int"
    return spark.createDataFrame([(*r, "x", 7, 9, "y", "z", 3, "dot", 4) for r in rows], shape)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SHAPE)
