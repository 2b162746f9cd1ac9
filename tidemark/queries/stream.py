"""Streaming queries: the events table replayed as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.queries.registry import query
from tidemark.sources.readers import read_table
from tidemark.sources.scratch import fresh_dir
from tidemark.streaming import sinks
from tidemark.streaming.replay import Replay
from tidemark.streaming.sources import file_stream, table_stream, with_event_time
from tidemark.streaming.windows import flat_window, windowed_count

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
LATE = "10 seconds"
BATCHES = 4


def _counts(width: str, only_closed: bool = False) -> str:
    closed = " HAVING time_bucket(INTERVAL '{w}', ts) + INTERVAL '{w}' <= (SELECT max(ts) FROM events) - INTERVAL '{late}'"
    return (
        "SELECT time_bucket(INTERVAL '{w}', ts) AS window_start, time_bucket(INTERVAL '{w}', ts) + INTERVAL '{w}' AS window_end, "
        "count(*) AS event_count FROM events GROUP BY time_bucket(INTERVAL '{w}', ts)" + (closed if only_closed else "")
    ).format(w=width, late=LATE)


def _stream(spark, sf):
    return with_event_time(table_stream(spark, sf, "events", EVENTS).select("ts"), "ts")


def _replay(spark, sf):
    """The events in order of time, to land in batches of many files; and the stream of them."""
    replay = Replay(spark, fresh_dir(spark, "replay")).stage(read_table(spark, sf, "events").select("ts"), "ts", BATCHES)
    return replay, with_event_time(replay.stream(), "ts")


def _counted(spark, sf, width):
    return flat_window(windowed_count(_stream(spark, sf), width=width, late=LATE))


@query(_counts("1 hour"))
def src_11_sql_over_stream(spark, sf):
    replay, stream = _replay(spark, sf)
    counts = windowed_count(stream, width="1 hour", late=LATE)
    name = sinks.to_memory(counts, sinks.unique_name("windows"), mode="complete", run=replay.run)
    return flat_window(spark.sql(f"SELECT * FROM {name} ORDER BY window"))


@query("SELECT event_id, event_type FROM events")
def src_14_file_stream(spark, sf):
    rows = table_stream(spark, sf, "events", EVENTS).select("event_id", "event_type")
    return sinks.to_parquet(rows, fresh_dir(spark, "stream"))


@query(_counts("1 hour"))
def snk_09_memory(spark, sf):
    """Update mode adds a row each time a batch changes a window; counts only grow, so the largest is the latest."""
    replay, stream = _replay(spark, sf)
    counts = flat_window(windowed_count(stream, width="1 hour", late=LATE))
    updates = spark.table(sinks.to_memory(counts, sinks.unique_name("windows"), mode="update", run=replay.run))
    return updates.groupBy("window_start", "window_end").agg(F.max("event_count").alias("event_count"))


@query(_counts("1 hour", only_closed=True))
def snk_10_durable(spark, sf):
    return sinks.to_parquet(_counted(spark, sf, "1 hour"), fresh_dir(spark, "stream"))


@query(_counts("1 day", only_closed=True))
def str_01_watermark(spark, sf):
    return sinks.to_parquet(_counted(spark, sf, "1 day"), fresh_dir(spark, "stream"))


@query(_counts("5 seconds"))
def str_02_tumbling(spark, sf):
    return sinks.to_latest(_counted(spark, sf, "5 seconds"), fresh_dir(spark, "stream"), ["window_start", "window_end"])


@query(_counts("1 hour"))
def str_03_update_mode(spark, sf):
    """Several batches, their folders merged on the way."""
    replay, stream = _replay(spark, sf)
    counts = flat_window(windowed_count(stream, width="1 hour", late=LATE))
    return sinks.to_latest(counts, fresh_dir(spark, "stream"), ["window_start", "window_end"], run=replay.run, every=2)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def str_04_life_cycle(spark, sf):
    counts = table_stream(spark, sf, "events", EVENTS).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return spark.table(sinks.to_memory(counts, sinks.unique_name("types"), mode="complete"))


@query(f"SELECT count(*) AS windows_captured, cast(sum(event_count) AS bigint) AS events FROM ({_counts('1 hour')})")
def str_05_read_result(spark, sf):
    replay, stream = _replay(spark, sf)
    counts = flat_window(windowed_count(stream, width="1 hour", late=LATE))
    table = spark.table(sinks.to_memory(counts, sinks.unique_name("windows"), mode="complete", run=replay.run))
    return table.agg(F.count(F.lit(1)).alias("windows_captured"), F.sum("event_count").alias("events"))


@query(_counts("1 day"))
def str_06_late_rows(spark, sf):
    """Everything arrives once; then all closed days arrive again, too late to count."""
    landing, folder = fresh_dir(spark, "landing"), fresh_dir(spark, "stream")
    events = read_table(spark, sf, "events").select("ts")

    def replay():
        stream = with_event_time(file_stream(spark, landing, "ts timestamp_ntz"), "ts")
        counts = flat_window(windowed_count(stream, width="1 day", late=LATE))
        return sinks.to_latest(counts, folder, ["window_start", "window_end"])

    events.write.mode("append").parquet(landing)
    replay()
    (last_day,) = events.agg(F.date_trunc("day", F.max("ts"))).first()
    events.filter(F.col("ts") < F.lit(last_day).cast("timestamp_ntz")).write.mode("append").parquet(landing)
    return replay()


@query(_counts("1 hour"))
def str_07_same_code_for_tables(spark, sf):
    table = with_event_time(read_table(spark, sf, "events").select("ts"), "ts")
    return flat_window(windowed_count(table, width="1 hour", late=LATE))
