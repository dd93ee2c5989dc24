import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, rows that repeat, columns with names that operators use."""
    rows = [
        (None, None, None, None, 1), (None, "", "en", "s", 2), (1, "Same text here", "en", "a", 3), (1, "Same text here", "en", "a", 3), (2, "same TEXT here", "en", "a", 4), (3, "", None, "a", 5),
        (4, " \t\n ", "en", None, 6), (5, "word " * 30_000, "en", "b", 7), (6, "x" * 200_000, "xx", "b", 8), (7, "Ää 日本 \U0001f600 \x1c\x85 mail a@b.co", "de", "b", 9), (8, "short", "fr", "c", 10),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, gl_digest int").withColumnsRenamed({}).selectExpr("*", "doc_id AS digest", "text AS fp", "1 AS size", "2 AS block", "3 AS row_id", "4 AS gl_id", "5 AS gl_score", "6 AS gl_row", "7 AS t", "8 AS words", "9 AS n")


@pytest.fixture(scope="session")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path
