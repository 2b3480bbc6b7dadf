import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang, source) as a table of documents."""

    def make(rows):
        filled = [(*r, *[None] * (4 - len(r)), None if len(r) < 2 or r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(filled, SCHEMA)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The documents of the smallest scale, collected."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    return [tuple(r) for r in rows]


@pytest.fixture
def clashing():
    """Extra columns named like those the operators make."""
    names = ("h", "key", "mix", "kept", "score", "keep_id", "size", "_text", "name", "doc", "task", "n_words", "c0", "Text2")
    return lambda df: df.select("*", *[F.lit("x").alias(n) for n in names])
