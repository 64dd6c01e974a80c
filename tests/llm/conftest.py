import duckdb
import pytest


@pytest.fixture(scope="session")
def texts(sf_dir):
    """``doc_id -> text`` of the given documents."""
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet'").fetchall()
    return dict(rows)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, long and repeated texts, tied ids, and columns that clash with the operators' own."""
    words = " ".join(f"word{k}" for k in range(40))
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(60_000))
    rows = [
        (1, words, "a", 1), (2, words, "a", 2), (3, words + " more", "b", 3), (4, "", "b", 4), (5, None, None, None),
        (None, words, "c", 5), (None, None, "c", 6), (6, "  \n ", "c", 7), (7, "one", "d", 8), (7, "one", "d", 8),
        (7, "One", "d", 9), (8, long, "d", 10), (9, long + " end", "e", 11), (10, "naïve ÉCOLE", "e", 12),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, row long")
    extra = {"key": 1, "node": 2, "run": 3, "part": 4, "id": 5, "w": 6, "component": 7, "best": 8, "n": 9, "size": 10}
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
