"""Filters, NULL handling, distinct, union, sort and top-k.

Only what is more than one call of the DataFrame API has a function here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_all(df: DataFrame, tests: list[Column]) -> DataFrame:
    """Rows for which every test holds; no test keeps all rows."""
    return reduce(DataFrame.filter, tests, df)


def after(df: DataFrame, column: str, moment: str) -> DataFrame:
    """Rows strictly later than a moment given as text.

    The text becomes a literal of the column's own type, so the comparison can be
    pushed to the files.
    """
    return df.filter(F.col(column) > F.lit(moment).cast(df.schema[column].dataType))


def fill_nulls(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in ``order``, which must end with a unique column.

    ``min_by`` combines before the shuffle, so a key with many copies sends one
    row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return picked.select(*(F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns))


def stacked(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union of frames with the same columns; duplicates stay."""
    return reduce(DataFrame.unionByName, others, first)


def duplicate_count(df: DataFrame, keys: list[str], name: str = "duplicates") -> DataFrame:
    """One row: rows minus distinct keys.

    Copies are counted per key first, which combines before the shuffle. NULL
    keys count as one distinct key.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return per_key.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias(name))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows. Each task keeps ``k``, so no full sort takes place."""
    return df.orderBy(*order).limit(k)


def sample_value(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """One row with one value of a column, the same in every run: the smallest."""
    return df.agg(F.min(column).alias(name or column))
