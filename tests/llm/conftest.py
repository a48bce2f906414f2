import random
import re

import pytest
from pyspark.sql import types as T

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile("[^\x20\x09-\x0D]+")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)
    return make


def prose(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def edge_rows():
    """NULL id, NULL and empty texts, blank texts, one word, repeated rows, a
    long text, odd white space and non-Latin letters."""
    rng = random.Random(5)
    long = " ".join(prose(rng, 30_000))
    return [(None, "no id here"), (None, "no id here"), (1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "word"), (6, "Word"),
            (7, "a b\x0bc\x0c d\r\ne"), (8, "a b c d e"), (9, "same row twice"), (9, "same row twice"), (10, long),
            (11, "x" * 5000), (12, "Ünï cödé \u4e16\u754c \U0001f600 end"), (13, "12345 67,5 !!! ???")]
