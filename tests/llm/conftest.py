import pytest
from pyspark.sql import types as T

from shelfwise.llm.common import Stages

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def stages(spark):
    return Stages(spark)


@pytest.fixture
def documents(spark):
    """A function from (doc_id, text[, lang[, source]]) rows to a documents table, dealt over a
    few partitions."""

    def make(rows, **more):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENT).repartition(3)
        for name, value in more.items():
            frame = frame.withColumn(name, value)
        return frame

    return make


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(frame, *columns):
        frame = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in frame.collect()), key=repr)

    return collect
