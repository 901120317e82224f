import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empties, ties, repeated rows, long text, clashing extra columns."""
    rows = [
        (1, None, "en", "a"), (2, "", "en", "b"), (3, "   \n ", None, "c"), (4, "!!! ... ###", "en", "d"),
        (5, "one", "en", "e"), (6, "the quick brown fox jumps over the lazy dog", "en", None),
        (7, "the quick brown fox jumps over the lazy dog", "en", "x"),
        (7, "the quick brown fox jumps over the lazy dog", "en", "x"),
        (8, "Der schnelle braune Fuchs springt über den faulen Hund\nund läuft", "de", "y"),
        (9, "word " * 30000, "en", "z"), (10, "é\u0000\n\ttab  two", "fr", "q"), (None, "no id here at all", "en", "n"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, id string")
    # names that the operators use inside
    for c in ("bucket", "node", "words", "score", "n", "row", "root", "keep", "a", "b", "line_no"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
