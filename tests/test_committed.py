"""Committed tables, the latest-row table and ordered replay: crashes, restarts, sizes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from compare import difference, spark_rows
from tidemark.sources.committed import CommittedTable, Conflict
from tidemark.sources.scratch import fresh_dir
from tidemark.streaming import sinks
from tidemark.streaming.latest import BASE, LatestTable
from tidemark.streaming.replay import Replay
from tidemark.streaming.sources import file_stream, with_event_time
from tidemark.streaming.windows import flat_window, windowed_count

START = dt.datetime(2024, 1, 1)
SCHEMA = StructType([StructField("k", LongType()), StructField("v", StringType())])
WINDOW = ["window_start", "window_end"]


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, SCHEMA).coalesce(1)


def content(frame):
    return sorted((r["k"] is None, r["k"] or 0, r["v"]) for r in frame.collect())


# --- manifests -----------------------------------------------------------------------


def test_a_table_is_what_its_manifest_says(spark):
    table = CommittedTable(spark, fresh_dir(spark, "table"))
    start = table.current()
    assert (start.number, start.folders, start.facts) == (0, {}, {})
    assert table.read([], SCHEMA).count() == 0
    one = table.write(rows(spark, (1, "a")), "rows")
    assert table.current() == start  # written, not published
    first = table.publish(start, {one: {"kind": "x"}}, {"mark": "m"})
    assert table.current() == first and first.number == 1 and first.facts == {"mark": "m"}
    assert content(table.read(list(first.folders), SCHEMA)) == [(False, 1, "a")]
    with pytest.raises(Conflict):
        table.publish(start, {}, {})
    assert table.current() == first


def test_what_nobody_needs_is_removed(spark):
    table = CommittedTable(spark, fresh_dir(spark, "table"), keep=2)
    now, folders = table.current(), []
    for i in range(5):
        folders.append(table.write(rows(spark, (i, "a")), "rows"))
        table.write(rows(spark, (i, "lost")), "rows")  # as left behind by a writer that died
        now = table.publish(now, {folders[-1]: {}}, {})
    assert sorted(table._names("data")) == sorted(folders[-2:])
    assert table._numbers() == [4, 5] and table.current() == now


# --- latest rows ---------------------------------------------------------------------


def test_folders_stay_few_over_many_batches(spark):
    table = LatestTable(spark, fresh_dir(spark, "latest"), SCHEMA, ["k"], every=3)
    want, most = {}, 0
    for i in range(31):
        new = [(i % 11, f"a{i}"), (None if i % 13 == 0 else 100 + i, f"b{i}")]
        want.update(new)
        table.add(rows(spark, *new), i)
        folders = table.folders()
        kinds = [known["kind"] for known in folders.values()]
        assert kinds.count(BASE) <= 1 and len(folders) <= 1 + 2 + 2
        most = max(most, len(folders))
        if i in (8, 17, 30):
            assert content(table.read()) == sorted((k is None, k or 0, v) for k, v in want.items())
    assert most == 5


def test_a_repeated_or_empty_batch_changes_nothing(spark):
    table = LatestTable(spark, fresh_dir(spark, "latest"), SCHEMA, ["k"], every=2)
    for i in range(3):
        table.add(rows(spark, (1, f"v{i}")), i)
    before = table.folders()
    table.add(rows(spark, (1, "again"), (2, "again")), 2)
    table.add(rows(spark, (3, "old")), 1)
    table.add(rows(spark), 3)
    assert table.folders() == before and content(table.read()) == [(False, 1, "v2")]


@pytest.mark.parametrize("dies", ["write", "publish"])
def test_a_merge_that_dies_loses_nothing(spark, monkeypatch, dies):
    folder = fresh_dir(spark, "latest")
    table = LatestTable(spark, folder, SCHEMA, ["k"], every=3)
    for i in range(2):
        table.add(rows(spark, (1, f"v{i}"), (10 + i, "x")), i)
    merge, calls = getattr(table.table, dies), []

    def once_then_die(*args):
        calls.append(args)
        if len(calls) == 2:  # the delta goes through, its merge does not
            raise OSError("lost")
        return merge(*args)

    monkeypatch.setattr(table.table, dies, once_then_die)
    with pytest.raises(OSError, match="lost"):
        table.add(rows(spark, (1, "v2"), (12, "x")), 2)
    again = LatestTable(spark, folder, SCHEMA, ["k"], every=3)
    want = [(False, 1, "v2"), *((False, 10 + i, "x") for i in range(3))]
    assert len(again.folders()) == 3 and content(again.read()) == want
    again.add(rows(spark, (1, "v2"), (12, "x")), 2)  # the stream repeats the batch it had not finished
    assert len(again.folders()) == 1 and content(again.read()) == want


def test_a_frame_outlives_later_batches(spark):
    table = LatestTable(spark, fresh_dir(spark, "latest"), SCHEMA, ["k"], every=2)
    table.add(rows(spark, (1, "first")), 0)
    old = table.read()
    for i in range(1, 6):
        table.add(rows(spark, (1, f"v{i}")), i)
    assert content(old) == [(False, 1, "first")] and content(table.read()) == [(False, 1, "v5")]


def test_latest_stream_over_restarts(spark):
    landing, folder = fresh_dir(spark, "landing"), fresh_dir(spark, "stream")
    for i in range(5):
        moments = [(START + dt.timedelta(seconds=5 * i + s),) for s in (0, 1, 6)]
        spark.createDataFrame(moments, "ts timestamp_ntz").coalesce(1).write.mode("append").parquet(landing)
        stream = with_event_time(file_stream(spark, landing, "ts timestamp_ntz"), "ts")
        counts = flat_window(windowed_count(stream, width="5 seconds", late="10 seconds"))
        got = sinks.to_latest(counts, folder, WINDOW, every=2)
    found = {(r["window_start"] - START).total_seconds(): r["event_count"] for r in got.collect()}
    assert found == {0: 2, 5: 3, 10: 3, 15: 3, 20: 3, 25: 1}


# --- replay --------------------------------------------------------------------------


def hot_events(spark, n=4_000):
    """Half of the rows at one moment."""
    second = F.when(F.col("id") % 2 == 0, 777).otherwise(F.col("id") % 2_000)
    return spark.range(0, n, 1, 4).select((F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=second)).alias("ts"))


def test_a_hot_moment_is_many_files(spark):
    folder = fresh_dir(spark, "events")
    hot_events(spark).write.parquet(folder)
    replay = Replay(spark, fresh_dir(spark, "replay")).stage(spark.read.parquet(folder), "ts", batches=4, file_rows=250)
    assert replay.waiting() == [f"batch={i}" for i in range(4)]
    files = (
        spark.read.option("recursiveFileLookup", True).parquet(replay.staged)
        .groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high"))
        .collect()
    )
    assert sum(f["n"] for f in files) == 4_000 and max(f["n"] for f in files) <= 250
    hot = START + dt.timedelta(seconds=777)
    assert sum(f["low"] <= hot <= f["high"] for f in files) >= 8
    # No batch reaches back behind the one before.
    spans = {}
    for f in files:
        number = int(f["file"].split("batch=")[1].split("/")[0])
        low, high = spans.get(number, (f["low"], f["high"]))
        spans[number] = min(low, f["low"]), max(high, f["high"])
    assert all(spans[i][1] <= spans[i + 1][0] for i in range(3))


def test_replay_gives_the_table_result(spark):
    folder = fresh_dir(spark, "events")
    hot_events(spark).unionByName(spark.createDataFrame([(None,)], "ts timestamp_ntz")).write.parquet(folder)
    events = spark.read.parquet(folder)
    replay = Replay(spark, fresh_dir(spark, "replay")).stage(events, "ts", batches=3, file_rows=500)
    # With no patience for late rows a batch out of order would lose rows.
    counts = flat_window(windowed_count(with_event_time(replay.stream(), "ts"), width="1 minute", late="0 seconds"))
    got = sinks.to_latest(counts, fresh_dir(spark, "stream"), WINDOW, run=replay.run, every=2)
    table = flat_window(windowed_count(with_event_time(events.filter("ts IS NOT NULL"), "ts"), width="1 minute"))
    assert difference(spark_rows(got), spark_rows(table)) is None
    assert replay.waiting() == []


def test_replay_goes_on_where_it_stopped(spark):
    folder, out = fresh_dir(spark, "events"), fresh_dir(spark, "stream")
    hot_events(spark, 400).write.parquet(folder)
    replay = Replay(spark, fresh_dir(spark, "replay")).stage(spark.read.parquet(folder), "ts", batches=3)
    landings = replay._landings

    def one_then_die():
        for name in landings():
            yield name
            raise OSError("lost")

    replay._landings = one_then_die
    with pytest.raises(OSError, match="lost"):
        sinks.to_parquet(replay.stream(), out, run=replay.run)
    assert len(replay.waiting()) == 2
    replay._landings = landings
    assert sinks.to_parquet(replay.stream(), out, run=replay.run).count() == 400


def test_replay_of_an_empty_table(spark):
    folder = fresh_dir(spark, "events")
    hot_events(spark, 0).write.parquet(folder)
    replay = Replay(spark, fresh_dir(spark, "replay")).stage(spark.read.parquet(folder), "ts", batches=2)
    assert sinks.to_parquet(replay.stream(), fresh_dir(spark, "stream"), run=replay.run).count() == 0
