import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows ``(doc_id, text)`` or ``(doc_id, text, source)`` as a documents table."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def texts(spark, sf):
    """``(doc_id, text)`` of the small documents table."""
    got = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in got]
