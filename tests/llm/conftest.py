from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""
    long = " ".join(f"word{i % 97} and" for i in range(6000)) + "\n" + "x" * 5000
    rows = [
        (1, "A plain line of text here.\nAnother line follows it.", "en", "a", 50),
        (1, "A plain line of text here.\nAnother line follows it.", "en", "a", 50),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t\n ", "en", None, 5),
        (None, "No id but a text of some words, all the same.", "en", "b", 46),
        (None, None, None, "b", None),
        (5, long, "en", "c", len(long)),
        (6, "A plain line of text here.\nAnother line follows it.", "en", "c", 50),
        (7, "日本語の文 and ümläute 🙂 here now", "ja", "Ä", 30),
    ]
    return spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS size", "2 AS part", "3 AS v", "4 AS score", "5 AS digest", "6 AS at_", "7 AS found_", "8 AS near_v"
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
