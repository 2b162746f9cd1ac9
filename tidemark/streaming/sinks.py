"""Running a stream to its end and reading what it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.sources.scratch import fresh_dir
from tidemark.streaming.latest import EVERY, LatestTable


class StreamTimeout(TimeoutError):
    """The stream did not reach the end of its input in time."""


def run_to_end(writer: DataStreamWriter, timeout: int | None = None) -> StreamingQuery:
    """Process all input there is at the start, then stop; with ``timeout`` (seconds), give up after it."""
    query = writer.trigger(availableNow=True).start()
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise StreamTimeout(f"stream {query.id} still running after {timeout} s")
    finally:
        query.stop()
    return query


# How a sink runs a stream: ``run_to_end``, or the ``run`` of a ``replay.Replay``.
Run = Callable[[DataStreamWriter, int | None], StreamingQuery]


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def _writer(stream: DataFrame, mode: str, folder: str) -> DataStreamWriter:
    return stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What a stream wrote; no rows if it found no input and wrote nothing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def to_memory(stream: DataFrame, name: str, mode: str = "update", timeout: int | None = None, run: Run = run_to_end) -> str:
    """Run into a table held by the driver and return its name.

    For results of known small size, such as counts per window. In update mode
    the table has a row for each change of a window, one per batch that touched it;
    ``mode="complete"`` keeps one row per window.
    """
    folder = fresh_dir(stream.sparkSession, "stream")
    run(_writer(stream, mode, folder).format("memory").queryName(name), timeout)
    return name


def to_parquet(stream: DataFrame, folder: str, timeout: int | None = None, run: Run = run_to_end) -> DataFrame:
    """Run in append mode into Parquet files, each row written once, and read them.

    A run that was interrupted goes on from its checkpoint when it is started with
    the same folder.
    """
    run(_writer(stream, "append", folder).format("parquet").option("path", f"{folder}/table"), timeout)
    return _read(stream.sparkSession, f"{folder}/table", stream.schema)


def to_latest(
    stream: DataFrame, folder: str, keys: list[str], timeout: int | None = None, run: Run = run_to_end, every: int = EVERY
) -> DataFrame:
    """Run in update mode and read the latest row of each key.

    Updates go to a ``LatestTable`` that merges its folders every so many batches. A
    restart neither loses nor doubles an update.
    """
    table = LatestTable(stream.sparkSession, f"{folder}/table", stream.schema, keys, every)
    run(_writer(stream, "update", folder).foreachBatch(table.add), timeout)
    return table.read()
