import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
PROSE = "the cat sat on a mat and looked at all the birds in the old garden near our house "
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r"),
    (4, "one"),
    (5, "one two three"),
    (6, "One TWO three"),
    (7, PROSE * 400),  # very long
    (8, "x" * 50_000),  # one very long word
    (9, "  café \U0001f600 <|endoftext|> naïve\u0085line"),
    (10, "mail a.b@c.de, 10.0.0.1 4111 1111 1111 1111 +1 (555) 123-4567 token = \"abcdef123\""),
    (10, "mail a.b@c.de, 10.0.0.1 4111 1111 1111 1111 +1 (555) 123-4567 token = \"abcdef123\""),
    (11, "same text here twice and more words"),
    (12, "same text here twice and more words"),
    (None, "no id but text"),
    (None, None),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with every oddity, and columns that operators use inside."""
    schema = (
        "doc_id long, text string, row int, source string, lang string, node string, "
        "score string, hits int, word string, n int, label int, parts string"
    )
    rows = [(i, t, 7, None, None, "n", "s", 1, "w", 2, 3, "p") for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row["doc_id"]: row["text"] or "" for row in documents.collect()}
