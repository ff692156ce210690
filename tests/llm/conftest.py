from __future__ import annotations

import pathlib
import sys

import pytest

# The session is the one the other tests build.
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from pyspark.sql.types import LongType, StringType, StructField, StructType  # noqa: E402

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table from (id, text) pairs."""
    return lambda rows: spark.createDataFrame(rows, DOCS)


#: Texts that every operator must survive: null, empty, blank, ties, repeated rows, odd characters.
ODD = [
    (1, None),
    (2, ""),
    (3, "  \n\t "),
    (4, "one"),
    (4, "one"),
    (5, "one"),
    (None, "no id here at all, really"),
    (6, "É\u0085\x1c  日本語 🎉 ÀB cd\x00ef"),
    (7, "word " * 3000),
    (8, "x" * 40_000),
]


@pytest.fixture(scope="session")
def odd(docs):
    return docs(ODD)
