"""Streams against tables, late rows, restarts; sources and joins on edge rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from compare import difference, spark_rows
from tidemark.operators import joins
from tidemark.operators.history import increment_report, read_mark, save_mark, since
from tidemark.operators.keyvalue import word_count, word_count_rdd
from tidemark.operators.relational import first_per_key
from tidemark.sources import readers
from tidemark.sources.readers import read_table
from tidemark.sources.scratch import fresh_dir, shared_root
from tidemark.streaming import sinks, sources
from tidemark.streaming.windows import flat_window, windowed_count

START = dt.datetime(2024, 1, 1)


def times(spark, *seconds):
    rows = [(START + dt.timedelta(seconds=s),) for s in seconds]
    return spark.createDataFrame(rows, "ts timestamp_ntz")


def land(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)


def counts(spark, landing):
    stream = sources.with_event_time(sources.file_stream(spark, landing, "ts timestamp_ntz"), "ts")
    return flat_window(windowed_count(stream, width="5 seconds", late="10 seconds"))


def as_dict(frame):
    return {(r["window_start"] - START).total_seconds(): r["event_count"] for r in frame.collect()}


def test_late_rows_are_dropped_and_rows_in_time_counted(spark):
    landing, folder = fresh_dir(spark, "landing"), fresh_dir(spark, "stream")
    land(times(spark, 1, 2, 31), landing)
    assert as_dict(sinks.to_latest(counts(spark, landing), folder, ["window_start", "window_end"])) == {0: 2, 30: 1}
    # the watermark stands at 21 s: 3 s comes too late, 24 s does not
    land(times(spark, 3, 24, 32), landing)
    assert as_dict(sinks.to_latest(counts(spark, landing), folder, ["window_start", "window_end"])) == {0: 2, 20: 1, 30: 2}


def test_append_writes_closed_windows_once(spark):
    landing, folder = fresh_dir(spark, "landing"), fresh_dir(spark, "stream")
    land(times(spark, 1, 2, 31), landing)
    assert as_dict(sinks.to_parquet(counts(spark, landing), folder)) == {0: 2}
    land(times(spark, 3, 60), landing)
    again = sinks.to_parquet(counts(spark, landing), folder)
    assert again.count() == 2 and as_dict(again) == {0: 2, 30: 1}


def test_stream_without_input(spark):
    landing = fresh_dir(spark, "landing")
    land(times(spark), landing)
    assert sinks.to_latest(counts(spark, landing), fresh_dir(spark, "stream"), ["window_start", "window_end"]).count() == 0


def test_files_in_small_batches_give_the_table_result(spark, folder):
    landing = fresh_dir(spark, "landing")
    events = read_table(spark, folder, "events").select("ts")
    for low in range(0, 30, 10):
        first = START + dt.timedelta(days=low)
        part = events.filter(
            (F.col("ts") >= F.lit(first).cast("timestamp_ntz"))
            & (F.col("ts") < F.lit(first + dt.timedelta(days=10)).cast("timestamp_ntz"))
        )
        land(part, landing)
    stream = sources.with_event_time(sources.file_stream(spark, landing, "ts timestamp_ntz", files_per_batch=1), "ts")
    streamed = sinks.to_latest(
        flat_window(windowed_count(stream, width="1 hour")), fresh_dir(spark, "stream"), ["window_start", "window_end"]
    )
    table = flat_window(windowed_count(sources.with_event_time(events, "ts"), width="1 hour"))
    assert difference(spark_rows(streamed), spark_rows(table)) is None


def test_rate_stream_in_memory(spark):
    counted = windowed_count(sources.rate_stream(spark, rows_per_second=50))
    name = sinks.unique_name("rate")
    query = (
        counted.writeStream.outputMode("update").format("memory").queryName(name)
        .option("checkpointLocation", fresh_dir(spark, "rate")).start()
    )
    try:
        for _ in range(60):
            if spark.sql(f"SELECT * FROM {name}").count() > 0:
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert spark.sql(f"SELECT max(event_count) AS n FROM {name}").first()["n"] > 0


def test_timeout_ends_the_run(spark):
    endless = sources.rate_stream(spark)
    writer = endless.writeStream.format("noop").option("checkpointLocation", fresh_dir(spark, "s"))
    writer.trigger = lambda **kw: writer  # keep the stream running instead of ending with its input
    with pytest.raises(sinks.StreamTimeout):
        sinks.run_to_end(writer, timeout=1)
    assert not spark.streams.active


# --- joins on edge rows ---------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("how", sorted(joins.JOINS))
def test_joins_equal_the_built_in(spark, how, seed):
    rng = random.Random(seed)
    keys = ["a", "a", "a", "b", "c", None, "only_fact"]
    facts = spark.createDataFrame([(rng.choice(keys), i) for i in range(40)], "k string, f int")
    lookup = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("only_lookup", 4), (None, 5)], "k string, d int")
    got = joins.JOINS[how](facts, lookup, "k")
    assert difference(spark_rows(got), spark_rows(facts.join(lookup, "k", how))) is None


def test_facts_per_lookup_row(spark):
    facts = spark.createDataFrame([("a",), ("a",), (None,), ("x",)], "k string")
    lookup = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    expected = facts.join(lookup, "k", "right").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert difference(spark_rows(joins.facts_per_lookup_row(facts, lookup, "k")), spark_rows(expected)) is None


def test_semi_and_anti_make_the_whole(spark, folder):
    documents, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    ids, marks = documents.select("doc_id"), labels.select("doc_id")
    assert joins.semi_join(ids, marks, "doc_id").count() + joins.anti_join(ids, marks, "doc_id").count() == ids.count()
    assert joins.semi_join(ids, marks, "doc_id").count() == joins.inner_join(ids, marks, "doc_id").count()


# --- other edge rows ------------------------------------------------------------


def test_words(spark):
    texts = spark.createDataFrame([("  Two  words\n two ",), ("",), (None,), ("\t",)], "text string")
    expected = {"two": 2, "words": 1}
    assert {r["word"]: r["n"] for r in word_count(texts).collect()} == expected
    assert {r["word"]: r["n"] for r in word_count_rdd(texts).collect()} == expected


def test_first_per_key_with_null_values(spark):
    frame = spark.createDataFrame([("a", 2, None), ("a", 1, None), ("b", 5, "x"), (None, 1, "y")], "k string, id int, v string")
    got = {r["k"]: (r["id"], r["v"]) for r in first_per_key(frame, ["k"], ["id"]).collect()}
    assert got == {"a": (1, None), "b": (5, "x"), None: (1, "y")}


def test_mark_itself_is_excluded(spark):
    frame = times(spark, 0, 1, 2)
    assert since(frame, "ts", "2024-01-01T00:00:01").count() == 1
    assert since(frame, "ts", None).count() == 3
    row = increment_report(frame, "ts", "2024-01-01T00:00:01").first()
    assert (row["total_records"], row["incremental_records"], row["incremental_ratio"]) == (3, 1, 33.3)
    assert increment_report(frame.limit(0), "ts", "2024-01-01").first()["incremental_ratio"] == 0


def test_stored_mark(spark):
    path = fresh_dir(spark, "mark")
    assert read_mark(spark, path) is None
    save_mark(times(spark, 0, 5), "ts", path)
    assert since(times(spark, 4, 5, 6), "ts", read_mark(spark, path)).count() == 1


def test_missing_input(spark, folder):
    with pytest.raises(readers.MissingInput, match="Run the loader first"):
        readers.read_required(spark, f"{folder}/no-such-table.parquet", "the loader")


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_root(spark) == named.rstrip("/")
