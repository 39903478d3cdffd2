import duckdb
import pytest

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [r.asDict() for r in docs.orderBy("doc_id").collect()]


LONG = "alpha beta gamma delta " * 20_000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows, clashing names."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "score", "label", "copies", "_text", "_salt", "_gone", "_row", "_key"]
    base = [
        (1, "", None, None, None), (2, None, "en", "a", 0), (3, " \t\n", "de", "b", 3), (4, LONG, "en", "a", len(LONG)),
        (5, "one two three four five", "fr", None, 23), (6, "one two three four five", None, "b", 23),
        (6, "one two three four five", None, "b", 23), (None, "one two three four five", "fr", "c", 23), (None, None, None, None, None),
        (7, "Größe 😀 no words\x00 here", "de", "c", 20), (8, "ONE two three four five six", "fr", "b", 27),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, copies long, _text string, _salt int, _gone long, _row string, _key long"
    return spark.createDataFrame([r + (0.5, 1, 7, "x", 1, 1, "y", 1) for r in base], schema).select(*names)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()
