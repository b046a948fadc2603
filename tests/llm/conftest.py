import glob
import os

import duckdb
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return connection


@pytest.fixture
def odd_docs(spark):
    """Rows with nulls, empty and very long texts, ties, repeats and columns of clashing names."""
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "one two three four five six", "en", "a", 27),
        (2, "one  two\tthree four\nfive six", "en", "a", 27),
        (2, "one  two\tthree four\nfive six", "en", "a", 27),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, long_text, None, "a", len(long_text)),
        (6, long_text + " end", "de", "b", 0),
        (None, "no id here", "en", "b", 10),
        (None, None, "en", "b", None),
        (7, " \t\n ", "en", "a", 4),
        (8, "é ÀB ﬁ <|endoftext|>  x  y", "fr", "b", 20),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    clash = ", digest string, id int, row int, words int, fingerprint int, n int, least int, n_tokens int, kept int"
    return spark.createDataFrame([r + ("x", 1, 1, 1, 1, 1, 1, 1, 1) for r in rows], schema + clash)
