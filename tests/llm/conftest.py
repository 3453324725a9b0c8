import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("shard", StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with an extra column whose name clashes with an added one."""
    return lambda rows: spark.createDataFrame([(i, t, "old") for i, t in rows], DOCS)


#: Nulls, empty, white space, a very long text, equal rows, ties.
EDGES = [
    (1, None), (None, "only a text"), (None, None), (2, ""), (3, " \n\t "), (4, "word " * 40_000), (5, "same text here now"),
    (6, "same text here now"), (6, "same text here now"), (7, "Größe 漢字 👍 naïve"), (-8, "x"),
]


@pytest.fixture(scope="session")
def edges():
    return EDGES
