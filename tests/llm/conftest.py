"""Small tables for the training-data operators."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 997}" for i in range(60_000))
# Nulls in every column, empty and very long texts, ties, repeated rows and ids, odd white space.
EDGE_ROWS = [
    (1, "the cat sat on the mat and looked at the dog", "en", "a", 44),
    (1, "the cat sat on the mat and looked at the dog", "en", "a", 44),
    (2, "the cat sat on the mat and looked at the dog", "en", "b", 44),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, "  \t\n ", "en", None, 5),
    (None, "All Rights reserved. CC  BY and general public license", "en", "c", 50),
    (None, None, None, None, None),
    (6, LONG, "en", "b", len(LONG)),
    (7, "one", "en", "c", 3),
    (7, "another text under the same id", "de", "a", 30),
    (8, "odd\x1cseparators here ΣΑΣ <|endoftext|> café café", "fr", "b", 40),
    (-9, "ALL RIGHTS RESERVED all rights reserved all", "en", "a", 43),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, COLUMNS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def spark():
    from storelens.session import build_session

    session = build_session("tests", "local[8]", 8, spark__ui__enabled="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


def rows_of(df, *columns):
    """Rows in a fixed order, nulls first."""
    rows = [tuple(r) for r in df.select(*columns or df.columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in r))


def clash(df):
    """The same rows with further columns named like those the operators make."""
    from pyspark.sql import functions as F

    names = ["size", "target", "copies", "taken", "weight", "uniform", "fp", "root", "content", "component_id",
             "n_words", "label", "labels", "score", "shard", "slot", "start", "offset", "repeat", "key", "word",
             "bucket", "part", "value", "quality", "toxic", "item_id", "page_id", "line"]
    return df.withColumns({name: F.lit("x") for name in names if name not in df.columns})
