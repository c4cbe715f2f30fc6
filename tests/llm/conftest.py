import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, row long, shard string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns whose names operators use."""
    long = " ".join(f"w{i * i % 9973} Zeta{i % 77}" for i in range(60_000))
    prose = "The first line stands here with words.\nA second line of the same text follows it,\n\nthe first and the last. "
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t\n ", "en", "a", 5), (4, "one", "en", "a", 3),
        (5, "one two", "en", "b", 7), (6, prose * 3, "en", "b", 1), (7, prose * 3, "de", None, 1), (7, prose * 3, "de", None, 1),
        (8, long, "en", "a", 9), (9, long + " tail of it", "en", "ä", 9), (None, prose, "en", "b", 2), (None, None, None, None, None),
        (10, "Été — çà ı İ ſ K   \x1f \x85   x", "fr", "𝄞", 3), (11, "a b c " * 40, "en", "b", 4),
    ]
    return spark.createDataFrame([(*r, 1, False, 2, "x") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
