"""Shared fixtures: given documents, and an edge table with clashing column names."""

import re

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
EDGE_ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "One  two\nthree"), (7, LONG), (8, LONG + " tail"),
    (9, "a b c d e " + PASSAGE + " f g"), (10, PASSAGE), (10, PASSAGE), (11, "x y " + PASSAGE), (12, "same " * 5000),
    (13, "same " * 5000), (None, PASSAGE), (14, "é ü ñ 日本   z"), (15, "a" * 70_000 + " b"),
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, ties, a repeated row, a null id, clashing extra columns."""
    return spark.createDataFrame(EDGE_ROWS, "doc_id long, text string").selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "'s' AS source", "7 AS n", "'z' AS score", "1 AS p",
        "2 AS hits", "3 AS component", "4 AS shard", "5 AS pos", "6 AS rep",
    )


@pytest.fixture(scope="session")
def empty(edges):
    return edges.limit(0)
