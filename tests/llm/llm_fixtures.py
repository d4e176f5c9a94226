import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from civicmart.llm.common import ship_package  # noqa: E402

FIXTURES = ("shipped", "documents", "awkward")
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) pairs, with columns of clashing names."""

    def build(pairs, source="s", extra=("h", "key", "part", "copy", "size", "words", "spans")):
        rows = [(i, t, "en", source(i) if callable(source) else source, None) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCUMENT)
        return df.withColumns({name: F.lit(name) for name in extra})

    return build


@pytest.fixture(scope="session")
def awkward(documents):
    """Null id, null text, empty text, a long text, no words, repeated rows, one id twice."""
    long = " ".join(f"wordé{i % 700} and" for i in range(30_000))
    pairs = [
        (None, "no id here, but some words follow after that"),
        (1, None),
        (2, ""),
        (3, long),
        (4, "?! ... --"),
        (5, "the same row again and again and again"),
        (5, "the same row again and again and again"),
        (6, "one id"),
        (6, "with two texts"),
        (7, ""),
    ]
    return documents(pairs)


def rows(df):
    """Rows as plain tuples, sorted by their text."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
