import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("row", T.StringType()),
     T.StructField("n", T.LongType()), T.StructField("tokens", T.StringType())]
)
PAGES = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
     T.StructField("key", T.StringType()), T.StructField("kind", T.StringType())]
)
LABELS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]
)
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def _maker(spark, schema):
    width = len(schema)

    def make(rows, partitions=3):
        full = [(*r, *["extra"] * (width - len(r))) for r in rows]
        full = [tuple(0 if f.dataType == T.LongType() and v == "extra" else v for v, f in zip(r, schema)) for r in full]
        return spark.createDataFrame(full, schema).repartition(partitions) if rows else spark.createDataFrame([], schema)

    return make


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with extra columns whose names the operators use inside."""
    return _maker(spark, DOCS)


@pytest.fixture(scope="session")
def pages_of(spark):
    return _maker(spark, PAGES)


@pytest.fixture(scope="session")
def labels_of(spark):
    return _maker(spark, LABELS)


@pytest.fixture(scope="session")
def items_of(spark):
    return _maker(spark, ITEMS)
