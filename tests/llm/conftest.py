"""Small tables for the operators, with what no operator may trip over."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A table from rows, as a frame that comes from no file."""

    def build(rows, schema=DOCUMENTS):
        return spark.createDataFrame(rows, T.StructType.fromDDL(schema))

    return build


@pytest.fixture(scope="session")
def odd_documents(make):
    """Nulls in every column, empty and long texts, repeated rows, clashing columns."""
    long_text = " ".join(f"word{i % 977}" for i in range(30_000))
    texts = [
        None,
        "",
        "   \n\t ",
        "...!!",
        "Hello there my friend",
        "hello THERE my friend",
        "one two three four five six seven eight nine ten",
        long_text,
        "ÄÖ Straße 漢字 🙂   x",
        "a\0b  c\n\n d ",
    ]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, "en" if i % 3 else None, "s1" if i % 2 else None, None))
    rows += [rows[4]] * 3 + [rows[0]] * 2 + [(None, "no id here", None, None, 1)] * 2
    rows.append((None, None, None, None, None))
    extra = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, "
        "size long, component_id string, __file string, kept int, ids binary, index string"
    )
    return make([(*r, 0.5, 7, "x", "y", 1, b"z", "i") for r in rows], extra)


@pytest.fixture(scope="session")
def no_documents(make):
    return make([])
