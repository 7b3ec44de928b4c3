import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def documents(spark):
    """Builds documents from (doc_id, text) or (doc_id, text, source)."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return build


@pytest.fixture
def labels(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return build
