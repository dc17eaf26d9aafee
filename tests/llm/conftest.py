import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType()),
                   # names that operators use inside
                   StructField("rid", StringType()), StructField("name", StringType()), StructField("k", LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table with extra, clashing columns from (doc_id, text[, lang]) rows."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "x", "y", 1) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
