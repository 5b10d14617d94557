import datetime

import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, id int, word string, fp int, when_seen date"


def doc(doc_id, text, source="a", extra=0):
    return Row(doc_id=doc_id, text=text, lang="en", source=source, n_chars=0, h="x", id=extra, word="w", fp=1, when_seen=datetime.date(2024, 1, 1))


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, source) rows, with extra columns that clash with names
    the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([doc(*r) for r in rows], DOCS)

    return make


LONG = "alpha Beta gamma\n" * 4000


@pytest.fixture(scope="session")
def messy(frame):
    """Nulls, empty and long texts, ties, repeated rows and ids."""
    return frame([
        (None, None, None), (None, "", "a"), (None, "one two three", "a"), (1, None, "a"), (1, "", "b"), (2, "   \n\t ", "b"),
        (3, "One two THREE", "a"), (3, "One two THREE", "a"), (3, "one two three", None), (4, "É é É", "b"), (5, LONG, "c"), (6, LONG, "c"),
        (7, "x", "c"), (-8, "a,b;c\x01d\u00a0e \u2003f", "d"), (9, "Ünïcödé 文字 🎉 <|endoftext|> it's 3.14 don't", "d"),
    ])


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
