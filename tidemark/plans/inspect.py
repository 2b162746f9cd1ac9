"""Plan text, for tests and for checking what a query reads and shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The physical plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def count_nodes(df: DataFrame, name: str) -> int:
    return physical_plan(df).count(name)


def partition_count(df: DataFrame) -> int:
    """Number of partitions a frame would be computed in."""
    return df.rdd.getNumPartitions()
