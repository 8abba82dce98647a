import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, tiny and very long texts, repeated rows, and
    columns whose names clash with names that the operators use."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(400)]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    plain = " ".join(rng.choice(words) for _ in range(120))
    rows = [
        (1, plain, "en", "a"), (1, plain, "en", "a"), (2, plain, "en", None), (3, None, "en", "a"), (4, "", None, "b"),
        (5, "x", "en", "b"), (6, " \t\n ", "de", "b"), (7, long, "de", "a"), (8, long + " tail", "de", "c"),
        (None, plain + " more words here", "en", "a"), (9, plain.upper(), "en", "c"), (10, "é ü ñ \U0001f600 漢字", None, None),
        (11, "line one two\nline one two\n\nline one two", "en", "a"),
    ]
    return spark.createDataFrame(
        [(i, t, l, s, 0, "e", 1.5, True) for i, t, l, s in rows],
        "doc_id long, text string, lang string, source string, n_words long, shard string, size double, kept boolean",
    )


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def tables():
    """DuckDB with the small tables, for the SQL of the queries."""
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con
