import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("words", T.StringType()),
                     T.StructField("key", T.StringType()), T.StructField("label", T.StringType())])


@pytest.fixture
def docs(spark):
    """Builds a documents table; the last three columns clash with names that the operators use inside."""
    def make(rows):
        full = [(i, t, lang, source, None if t is None else len(t), "w", "k", "l") for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCS)
    return make


LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))


@pytest.fixture
def edge_rows():
    """Null id, null and empty texts, repeated rows, a very long text."""
    return [(None, "some text without an id that is long enough to have a few shingles", "en", "a"), (1, None, "en", None),
            (2, "", None, "a"), (3, "repeated row with several plain words in it", "en", "a"),
            (3, "repeated row with several plain words in it", "en", "a"), (4, LONG, "en", "b"), (5, "---", "de", "b")]
