"""Increments: rows and mark together, and merged versions against a rebuild."""

import datetime as dt
import random

import pytest

from compare import difference, spark_rows
from tidemark.operators import history
from tidemark.operators.blocks import Limits
from tidemark.operators.increments import IncrementalTable, VersionedTable
from tidemark.sources.scratch import fresh_dir

START = dt.datetime(2024, 1, 1)
LOG = "k string, at timestamp_ntz, id long, a string, b int"


def moments(spark, *seconds):
    rows = [(i, None if s is None else START + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "id long, at timestamp_ntz").coalesce(1)


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


# --- rows and mark -------------------------------------------------------------------


def test_each_row_is_taken_once(spark):
    source = moments(spark, 0, 1, 2, 3, 4, 5, 6, 7, 8)
    table = IncrementalTable(spark, fresh_dir(spark, "inc"), source.schema, "at", every=2)
    assert table.mark() is None and ids(table.read()) == []
    for n in range(1, 10):
        table.process(source.filter(f"id < {n}"))
        table.process(source.filter(f"id < {n}"))  # nothing new
        assert ids(table.read()) == list(range(n))
        assert len(table.table.current().folders) <= 4
    assert table.mark() == "2024-01-01 00:00:08"


def test_mark_of_instants_does_not_depend_on_the_zone(spark):
    source = moments(spark, 0, 3600).selectExpr("id", "cast(at AS timestamp) AS at")
    table = IncrementalTable(spark, fresh_dir(spark, "inc"), source.schema, "at")
    table.process(source)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert history.since(source, "at", table.mark()).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_the_mark_follows_the_rows_that_went_in(spark):
    source = moments(spark, 0, 5, None)
    table = IncrementalTable(spark, fresh_dir(spark, "inc"), source.schema, "at")
    assert table.process(source, lambda rows: rows.filter("id = 2")) == "2024-01-01 00:00:05"
    assert ids(table.read()) == [2]
    assert table.process(source) == "2024-01-01 00:00:05" and ids(table.read()) == [2]
    assert table.process(source.limit(0)) == "2024-01-01 00:00:05"


@pytest.mark.parametrize("dies", ["write", "publish"])
def test_a_crash_neither_loses_nor_repeats_rows(spark, monkeypatch, dies):
    folder, source = fresh_dir(spark, "inc"), moments(spark, 0, 1, 2)
    table = IncrementalTable(spark, folder, source.schema, "at", every=2)
    table.process(source.filter("id = 0"))
    step = getattr(table.table, dies)

    def lost(*args):
        if dies == "write":
            step(*args)  # the rows are there, the process is not
        raise OSError("lost")

    monkeypatch.setattr(table.table, dies, lost)
    with pytest.raises(OSError, match="lost"):
        table.process(source)
    again = IncrementalTable(spark, folder, source.schema, "at", every=2)
    assert ids(again.read()) == [0] and again.mark() == "2024-01-01 00:00:00"
    again.process(source)
    assert ids(again.read()) == [0, 1, 2]


# --- versions ------------------------------------------------------------------------


def log(spark, rng, n):
    keys = ["hot"] * 6 + ["a", "b", None, "c"]
    rows = [
        (rng.choice(keys), START + dt.timedelta(days=rng.randrange(12)), i, rng.choice(["x", "y", None]), rng.randrange(3))
        for i in range(n)
    ]
    return rows


def rebuilt(spark, rows):
    return history.versions(spark.createDataFrame(rows, LOG), "k", "at", "id", ["a", "b"])


def table_of(spark, folder, buckets=4):
    return VersionedTable(spark, folder, spark.createDataFrame([], LOG).schema, "k", "at", "id", ["a", "b"], buckets)


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_increments_gives_the_rebuild(spark, seed):
    rng = random.Random(seed)
    rows = log(spark, rng, 80)
    rng.shuffle(rows)
    table, at = table_of(spark, fresh_dir(spark, "versions")), 0
    while at < len(rows):
        size = rng.randrange(1, 40)
        # Some changes are delivered again, some increments are cut into blocks.
        part = rows[at : at + size] + rows[:at][: rng.randrange(3)]
        limits = Limits(one_task_bytes=0, group_rows=10) if rng.random() < 0.5 else Limits()
        table.merge(spark.createDataFrame(part, LOG), limits)
        at += size
        assert difference(spark_rows(table.read()), spark_rows(rebuilt(spark, rows[:at]))) is None


def test_only_touched_buckets_are_written(spark):
    folder = fresh_dir(spark, "versions")
    table = table_of(spark, folder, buckets=8)
    rows = [(f"k{i}", START, i, "x", 0) for i in range(40)]
    assert table.merge(spark.createDataFrame(rows, LOG)) == 8
    before = table.table.current()
    late = ("k3", START - dt.timedelta(days=1), 100, "earlier", 1)
    assert table.merge(spark.createDataFrame([late], LOG)) == 1
    after = table.table.current()
    (old,) = before.folders
    assert len(after.folders[old]["buckets"]) == 7
    assert difference(spark_rows(table.read()), spark_rows(rebuilt(spark, [*rows, late]))) is None
    # The number of buckets is the table's own.
    assert table_of(spark, folder, buckets=3).buckets == 8


def test_an_empty_or_lost_increment_changes_nothing(spark, monkeypatch):
    folder = fresh_dir(spark, "versions")
    table = table_of(spark, folder)
    assert table.merge(spark.createDataFrame([], LOG)) == 0 and table.read().count() == 0
    rows = [("a", START, 1, "x", 0), ("b", START, 2, "y", 0)]
    table.merge(spark.createDataFrame(rows, LOG))
    publish = table.table.publish
    monkeypatch.setattr(table.table, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.merge(spark.createDataFrame([("a", START, 3, "z", 0)], LOG))
    monkeypatch.setattr(table.table, "publish", publish)
    assert difference(spark_rows(table_of(spark, folder).read()), spark_rows(rebuilt(spark, rows))) is None


