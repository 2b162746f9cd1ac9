"""Unbounded inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.functions.casts import utc_instant


def rate_stream(spark: SparkSession, rows_per_second: int = 5) -> DataFrame:
    """Rows ``timestamp, value`` made at a steady rate, for trying out a query."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files that land in a folder, each read once."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def table_stream(spark: SparkSession, folder: str, name: str, schema: StructType | str) -> DataFrame:
    """Replay one Parquet table of a folder, whether it is a file or a folder of files.

    The last letter is given as a pattern, because the file source takes a plain
    path for a folder.
    """
    return file_stream(spark, f"{folder}/{name}.parque[t]", schema)


def with_event_time(df: DataFrame, column: str, name: str = "timestamp") -> DataFrame:
    """A zone-free event time as an instant, the type watermarks ask for."""
    return df.withColumn(name, utc_instant(column))
