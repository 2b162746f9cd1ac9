"""Grouped lists and aggregates over one shared input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import bit
from tidemark.operators.blocks import Limits
from tidemark.operators.windows import numbered


def count_where(predicate: Column) -> Column:
    """Number of rows for which the predicate holds."""
    return F.sum(bit(predicate))


def first_in_group(value: str, *order: str) -> Column:
    """Value of the earliest row. ``order`` must end with a unique column."""
    return F.min_by(value, F.struct(*order))


def listed_long(
    df: DataFrame, keys: list[str], value: str, order: list[str], limits: Limits = Limits()
) -> DataFrame:
    """The values of each group in ``order`` (ending with a unique column), one per row: keys, ``position``, value.

    The form for groups of any size; positions count from 1.
    """
    rows = numbered(df.select(*dict.fromkeys([*keys, value, *order])), keys, order, limits, name="position")
    return rows.select(*keys, "position", value)


def listed(
    df: DataFrame,
    keys: list[str],
    value: str,
    order: list[str],
    name: str = "values",
    *,
    list_rows: int,
    limits: Limits = Limits(),
) -> DataFrame:
    """The values of each group as arrays, in ``order`` (ending with a unique column).

    A group is one row (``part`` 0) as long as it has at most ``list_rows``
    values; a larger one goes on in parts 1, 2, ... so that no row, and no task,
    has to hold an unbounded list. ``listed_long`` has the same values without parts.
    """
    part = F.floor((F.col("_n") - 1) / list_rows).cast("long")
    rows = numbered(df.select(*keys, value, *order), keys, order, limits, name="_n").select(
        *keys, part.alias("part"), F.struct("_n", value).alias("_item")
    )
    lists = rows.groupBy(*keys, "part").agg(F.sort_array(F.collect_list("_item")).alias("_items"))
    return lists.select(*keys, "part", F.col(f"_items.{value}").alias(name))


def by_each(df: DataFrame, dimensions: list[str], measures: dict[str, Column]) -> DataFrame:
    """The same measures grouped by each dimension in turn, from one scan.

    Long format: ``dimension``, its ``value`` as text, the measures. Grouping sets
    combine before the shuffle, so the scan is shared without caching the rows.
    """
    sets = [[F.col(d)] for d in dimensions]
    grouped = df.groupingSets(sets, *dimensions).agg(
        F.grouping_id().alias("_set"), *(c.alias(n) for n, c in measures.items())
    )
    # grouping_id has one bit per column, set where the column is not grouped by.
    full = (1 << len(dimensions)) - 1
    ids = [full ^ (1 << (len(dimensions) - 1 - i)) for i in range(len(dimensions))]
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for d, i in zip(dimensions, ids):
        name = F.when(F.col("_set") == i, F.lit(d)).otherwise(name)
        value = F.when(F.col("_set") == i, F.col(d).cast("string")).otherwise(value)
    return grouped.select(name.alias("dimension"), value.alias("value"), *measures)
