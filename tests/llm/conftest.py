import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use for what they add
    T.StructField("score", T.StringType()), T.StructField("quality", T.StringType()), T.StructField("_mix", T.StringType()),
    T.StructField("ids", T.StringType()), T.StructField("h", T.StringType()), T.StructField("lang_pred", T.StringType()),
])
LONG = " ".join(f"word{i}x{i * 7919 % 1000}" for i in range(30_000)) + " the end."
PROSE = "the house of the river and a boat is on it as the day was long and he was at the door of that house again with bread"
ROWS = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"),  # copies, and a repeated row
    (3, None, "en", "a"), (4, "", None, None), (5, " \n\t ", "de", "b"), (None, "der Hund und die Katze", "de", "b"),
    (None, None, None, None), (7, LONG, "en", "b"), (8, "!!! ### $$$", "fr", "b"), (9, "x" * 50_000, "fr", "c"),
    (10, "Ünïcödé 漢字 😀 it's <|endoftext|> don't", "de", "c"), (10, "another text under the same id", "en", "c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, lang, s, None if t is None else len(t), "x", "x", "x", "x", "x", "x") for i, t, lang, s in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given():
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no given tables here")
    return path
