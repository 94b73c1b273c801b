import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

LONG = "the quick brown fox jumps over the lazy dog again. " * 6000

#: nulls in every column, empty and very long texts, ties and repeated rows
ODD = [
    (1, "Some plain words that stand in a short text.", "en", "a", 44),
    (2, "Some plain words that stand in a short text.", "en", "a", 44),
    (2, "Some plain words that stand in a short text.", "en", "a", 44),
    (3, None, None, None, None),
    (None, "A text without an id, and with ümlauts.", "de", "b", 10),
    (None, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "fr", None, 3),
    (6, LONG, "en", "a", len(LONG)),
    (7, "!!! ??? 12345", None, "c", 13),
    (8, "word", "en", "a", 4),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def documents(spark):
    def make(*texts, source="a"):
        return spark.createDataFrame([(i, t, "en", source, 0) for i, t in enumerate(texts)], DOCUMENTS)

    return make


@pytest.fixture
def folder_of(spark, tmp_path):
    """A folder with the given frames as tables, for the queries."""

    def write(**frames):
        for name, frame in frames.items():
            frame.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
