import pytest

EDGE = [
    # doc_id, text, source, lang, and columns whose names clash with results
    (3, "alpha  beta\tgamma delta epsilon zeta", "b", "en", 1, "x"),
    (1, "alpha beta gamma delta epsilon zeta", "a", "en", 2, "y"),
    (1, "alpha beta gamma delta epsilon zeta", "a", "en", 2, "y"),
    (2, None, None, None, 3, None),
    (4, "", "a", "de", 4, "z"),
    (None, "one row without an id but with a text that is long enough to have some anchors in it", "b", "fr", 5, "w"),
    (7, None, "c", None, None, None),
    (8, "  \n\t ", "c", "en", 6, "v"),
    (9, "token = 'abcdef0123456789abcdef0123' and é ü 😀 more", "é", "en", 7, "u"),
    (10, "Ünïcode 😀 " * 40_000, "b", "de", 8, "t"),
    (11, "Ünïcode 😀 " * 40_000, "b", "de", 8, "t"),
]
SCHEMA = "doc_id long, text string, source string, lang string, size int, spans string"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, repeated rows, names that clash."""
    return spark.createDataFrame(EDGE, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))
