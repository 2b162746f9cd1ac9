"""A caller's function over records: rejected ones stay rows, and end nothing."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tidemark.operators.records import accepted, mapped_records, rejected

LINES = [(1, '{"a": 1, "b": "x"}'), (2, "{"), (3, '{"a": "one"}'), (4, None), (5, '{"a": null}'), (6, '{"drop": true}'), (6, '{"drop": true}'), (7, "[]")]


@pytest.fixture
def fields():
    """Made here, so that it travels to the workers by value."""

    def found(line):
        record = json.loads(line)
        return None if record.get("drop") else {"a": record["a"], "b": record.get("b")}

    return found


def test_good_and_bad_records(spark, fields):
    lines = spark.createDataFrame(LINES, "id long, value string").repartition(3)
    got = mapped_records(lines, "value", fields, "a long, b string", keep=["id"])
    assert got.columns == ["id", "a", "b", "_error", "_record"]
    assert sorted(tuple(r) for r in accepted(got).collect()) == [(1, 1, "x"), (5, None, None)]
    bad = {r["id"]: (r["_error"], r["_record"]) for r in rejected(got).collect()}
    assert bad == {2: ("JSONDecodeError", "{"), 3: ("BadFields", '{"a": "one"}'), 4: ("TypeError", None), 7: ("AttributeError", "[]")}


def test_edges(spark, fields):
    none = spark.createDataFrame([], "value string")
    assert mapped_records(none, "value", fields, "a long, b string").count() == 0
    lines = spark.createDataFrame([("x" * 1_000_000,), ("",)], "value string")
    assert sorted(r["n"] for r in mapped_records(lines, "value", lambda v: {"n": len(v)}, "n int").collect()) == [0, 1_000_000]
    dropped = mapped_records(lines, "value", lambda v: None, "n int")
    assert dropped.count() == 0
    for bad in ("_error string", "value long"):
        with pytest.raises(ValueError):
            mapped_records(lines, "value", fields, bad, keep=["value"])


def test_no_memory_is_raised(spark):
    def hungry(value):
        raise MemoryError("no memory")

    lines = spark.createDataFrame([("x",)], "value string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        mapped_records(lines, "value", hungry, "n int").collect()
