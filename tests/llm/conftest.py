from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, kept string, rate string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa "
    rows = [
        (1, word * 3, "en", "a", 1, 9, "x", "y"), (1, word * 3, "en", "a", 1, 9, "x", "y"), (2, word * 3, "en", None, None, None, None, None),
        (3, None, None, "b", 2, 1, "x", "y"), (4, "", "de", "b", 2, 1, "x", "y"), (None, word * 4, "en", "a", 3, 3, "x", "y"),
        (5, " \t\n ", "fr", "c", 1, 1, "x", "y"), (6, "é" * 50_000, "fr", "c", 1, 1, "x", "y"),
        (7, "one two", "en", "a", 1, 1, "x", "y"), (8, "one two", "en", "a", 1, 1, "x", "y"), (9, "Lorem ipsum. " * 4000, "en", "a", 1, 1, "x", "y"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
