from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, score double, row string, fp string"

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))


def rows():
    texts = [
        (1, "The cat sat on the mat and looked at the quiet moon tonight."),
        (2, "The cat sat on the mat and looked at the quiet moon tonight."),
        (3, "Write to ann.lee+x@mail.example.com or +44 (020) 7946-0018, host 10.0.0.255, 4111 1111 1111 1111."),
        (4, ""),
        (5, None),
        (6, "word"),
        (7, LONG),
        (8, "été  ñandú\n\ttabs 日本語 😀 end"),
        (8, "été  ñandú\n\ttabs 日本語 😀 end"),
        (8, "another text under the same id"),
        (None, "a row without an id has text as well"),
        (None, None),
        (9, "   \n "),
    ]
    return [
        (i, t, "en", None if k % 5 == 4 else f"s{k % 3}", len(t or ""), k, 0.5, "r", "f") for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and very long texts, ties, repeated rows, columns with clashing names."""
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
