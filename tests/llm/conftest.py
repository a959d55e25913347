import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
WORDS = ("the of and stone river lamp paper glass winter garden letter music number market window bridge school island "
         "doctor planet history energy camera silver copper forest").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed", "er", "ly"]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text, odd characters."""
    import random

    rng = random.Random(4)
    base = prose(rng, 120)
    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t ", "en", "b", 4), (4, "one", "en", "a", 3),
        (5, "one two three four", "en", None, 18), (6, "one two three four", "de", "b", 18), (7, base, "en", "a", len(base)),
        (8, base, "en", "b", len(base)), (9, base.upper(), "en", "c", 0), (10, base + " tail", "en", "c", 0),
        (11, prose(rng, 30_000), "en", "a", 0), (12, "é😀 ünï " * 60, "fr", "b", 0), (13, "x" * 5000, "en", "b", 0),
        (None, "nobody knows this row", None, None, None), (14, "twice the same row", "en", "a", 1),
        (14, "twice the same row", "en", "a", 1),
    ]
    return rows + [(100 + i, prose(rng, rng.randint(1, 200)), "en", rng.choice("abc"), 0) for i in range(40)]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows, SCHEMA).repartition(4, "doc_id")
    # Extra columns whose names operators might use for themselves.
    return docs.withColumn("score", F.lit("mine")).withColumn("node", F.lit(1)).withColumn("shard", F.lit("s"))


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
