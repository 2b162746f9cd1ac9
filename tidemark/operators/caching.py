"""Keeping a shared input for the length of a block of code."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> Iterator[DataFrame]:
    """Persist a frame for several actions and release it at the end.

    Select the columns and rows that are needed first, or aggregate: what is
    cached should be far smaller than what was read. Lost blocks are recomputed.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
