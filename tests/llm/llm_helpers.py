"""What the tests of the text operators share."""

import os
import random

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def pairs(df, *columns):
    """Rows in an order of their own, nulls first."""
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    return sorted(rows, key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))


DOCS = "doc_id long, text string, lang string, source string, n_chars long, start long, score double, word string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows, and columns named like results."""
    r = random.Random(5)
    long = " ".join(r.choice(["alpha", "beta", "Gamma", "déjà", "vu", "x" * 50]) for _ in range(30_000))
    rows = [
        (1, "The cat sat on the mat and looked at the dog for a while .", "en", "a", 1, 2, 0.5, "w"),
        (1, "The cat sat on the mat and looked at the dog for a while .", "en", "a", 1, 2, 0.5, "w"),
        (2, "the cat sat on the mat and looked at the dog for a while .", None, None, None, None, None, None),
        (3, None, "en", "a", 1, 2, 0.5, "w"),
        (4, "", "en", "a", 1, 2, 0.5, "w"),
        (None, "a text without an id", "en", "a", 1, 2, 0.5, "w"),
        (None, None, None, None, None, None, None, None),
        (5, " \t\n ", "en", "a", 1, 2, 0.5, "w"),
        (6, long, "en", "a", 1, 2, 0.5, "w"),
        (7, "x" * 5000, "en", "a", 1, 2, 0.5, "w"),
        (8, "ünï cödé 日本 🙂 \x00 ▁ <s> <|endoftext|>\r\n", "en", "a", 1, 2, 0.5, "w"),
        (9, "single", "en", "a", 1, 2, 0.5, "w"),
        (9, "another text with the id of a single", "en", "a", 1, 2, 0.5, "w"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
