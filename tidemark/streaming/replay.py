"""A table played back as a stream, in order of time and in batches of many files.

The table is first staged: cut by range of its time into pieces of about
``file_rows`` rows, each written by its own task as one or more files of no more
rows, and consecutive pieces put into one folder a batch. Rows of one moment may lie
in several pieces, so that a moment with half of all rows is still many files.
Then the folders are moved one after the other to where a running stream looks, and
the next one waits until the stream has processed all of the one before. No batch
has a row earlier than the last moment of the batch before it, so what a watermark
drops does not depend on how files are listed or read.

A batch that was moved but not processed when a run ended is taken up by the next
run with the same folder and checkpoint; batches are moved in the order of their
numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

BATCH = "batch"
FILE_ROWS = 1_000_000
POLL = "200 milliseconds"
_DICE = "_dice"


class Replay:
    """Batches of a table, waiting in one folder and landing in another."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.staged, self.landing = spark, f"{folder}/staged", f"{folder}/landing"
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.landing).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.landing))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def stage(self, df: DataFrame, time: str, batches: int, file_rows: int = FILE_ROWS) -> Replay:
        """Write a table as batches in order of ``time``; rows without a time come first.

        ``df`` should read a stored table: a task that runs again must find the same rows.
        """
        pieces = max(batches, math.ceil(df.count() / file_rows))
        # Equal rows must not share a place in the order, else a hot moment could not be cut.
        diced = df.withColumn(_DICE, F.xxhash64(F.monotonically_increasing_id()))
        ranged = diced.repartitionByRange(pieces, F.col(time).asc_nulls_first(), _DICE)
        number = F.floor(F.spark_partition_id() * F.lit(batches) / F.lit(pieces)).cast("int")
        (
            ranged.withColumn(BATCH, number).drop(_DICE)
            .write.option("maxRecordsPerFile", file_rows).partitionBy(BATCH).parquet(self.staged)
        )
        self.schema = df.schema
        return self

    def waiting(self) -> list[str]:
        """Folders of batches that have not landed, in order."""
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.staged)) if s.isDirectory()]
        return sorted((f for f in found if f.startswith(f"{BATCH}=")), key=lambda f: int(f.split("=")[1]))

    def stream(self) -> DataFrame:
        """The rows that land, as a stream."""
        return self.spark.readStream.schema(self.schema).option("recursiveFileLookup", True).parquet(self.landing)

    def _landings(self) -> Iterator[str]:
        for name in self.waiting():
            if not self._fs.rename(self._path(f"{self.staged}/{name}"), self._path(f"{self.landing}/{name}")):
                raise OSError(f"{name} cannot be moved to {self.landing}")
            yield name

    def run(self, writer: DataStreamWriter, timeout: int | None = None) -> StreamingQuery:
        """Start a stream, let all batches land one by one, and stop it when the last is processed.

        For the sinks, in place of ``run_to_end``. ``timeout`` is not used: the run ends with its input.
        """
        query = writer.trigger(processingTime=POLL).start()
        try:
            query.processAllAvailable()
            for _ in self._landings():
                query.processAllAvailable()
        finally:
            query.stop()
        return query
