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


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, "One two three. " * 40, "en", "a", 10),
        (1, "One two three. " * 40, "en", "a", 10),
        (2, None, None, None, None),
        (None, "word " * 120, "en", None, 3),
        (None, None, None, "a", 3),
        (3, "", "en", "b", 0),
        (4, " \t\n\r ", "en", "b", 4),
        (5, "ÄÖ ß ñ 日本 " * 30, "de", "b", 5),
        (6, " ".join(f"w{i % 977}x{i}" for i in range(60_000)), "en", "c", 1),
        (7, "x" * 70_000, "en", "c", 1),
        (8, "One two three. " * 40, "en", "b", 10),
        (-9, "a\x00b c\x1dd e\x85f " * 20, "en", "é", 7),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def crowded(awkward):
    """The same with extra columns named like those the operators make."""
    extra = "key size host row rid _rid _ord _row _text shard slot score kept position target label n_words".split()
    frame = awkward
    for name in extra:
        frame = frame.withColumn(name, awkward["lang"])
    return frame


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
