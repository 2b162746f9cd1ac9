import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")]
)

LONG = "lorem ipsum dolor " * 20_000
AWKWARD = [
    (1, None, "a"),
    (2, "", "b"),
    (3, "   \n\t ", None),
    (4, "one", "c"),
    (4, "one", "c"),
    (None, "the quick brown fox jumps over the lazy dog again and again today", "d"),
    (5, LONG, "e"),
    (6, "a" * 100_000, "f"),
    (7, "1 2-3 " * 20_000, "g"),
    (8, "a.b.c@" * 5_000 + "x" + ".y" * 20_000, "h"),
    (9, "Ünïcode Straße ſecret K 日本語 \U0001f600 " * 5, "i"),
    (10, "a\x1cb\x0bc d e", "j"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs, empty and very long texts, repeated rows, and columns with the operators' own names."""
    rows = [(i, t, s, "x", 1, [1], "y") for i, t, s in AWKWARD]
    schema = "doc_id long, text string, source string, key string, failed int, measures array<int>, row string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
