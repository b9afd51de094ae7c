import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def texts(spark):
    """A small table of documents from (id, text) pairs, with extra columns whose names clash with inner ones."""

    def make(rows):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
        df = spark.createDataFrame(rows, schema)
        for name in ("id", "h", "fp", "n", "key", "size", "shard", "_key", "_part", "kept", "a", "b", "at", "gram"):
            df = df.withColumn(name, F.lit("clash"))
        return df

    return make
