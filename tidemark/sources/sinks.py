"""Writers. Each replaces what the path held."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from tidemark.plans.sizing import MB, UNKNOWN, estimated_bytes, fits_one_task, spread_if_small

# Files of this size are large enough to scan well and small enough to split.
FILE_BYTES = 512 * MB


def write_parquet(df: DataFrame, path: str, codec: str = "snappy") -> str:
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: list[str], codec: str = "snappy") -> str:
    """Hive-style folders, one level per column.

    The rows are brought together by the partition columns first, so that a
    folder is not fed by every task. Of a large input the rows are rebalanced:
    adaptive execution joins small folders into one task and splits a folder that
    holds a large share of the rows over several.
    """
    balanced = spread_if_small(df, *by) if fits_one_task(df) else df.hint("rebalance", *by)
    balanced.write.mode("overwrite").option("compression", codec).partitionBy(*by).parquet(path)
    return path


def file_count(df: DataFrame, at_least: int, file_bytes: int = FILE_BYTES) -> int:
    """How many files a frame should be written to: grows with its size."""
    size = estimated_bytes(df)
    return at_least if size == UNKNOWN else max(at_least, math.ceil(size / file_bytes))


def with_few_files(df: DataFrame, at_least: int = 4, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Merge partitions so that a write makes few, full files.

    Without a shuffle. ``at_least`` is met only where the frame has that many
    partitions; it rises with the size, so no task is given more than about
    ``file_bytes`` to write. A frame of unknown size keeps its partitions.
    """
    if estimated_bytes(df) == UNKNOWN:
        return df
    return df.coalesce(file_count(df, at_least, file_bytes))
