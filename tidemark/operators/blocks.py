"""Splitting groups that are too large for one task.

A window function needs its whole group in order, and Spark gives a group to one
task. That fails when one key holds a third of a large table. Here such groups
are found by counting, and only their rows are cut into *blocks*: contiguous
pieces of the group in its own order, each small enough for a task. A window
operator then works in three steps,

1. evaluate the function inside each block,
2. summarise every block in one row and carry the summaries from block to block
   (a window over at most a few rows per million input rows),
3. add the carry to the rows of the block.

All other groups take the plain window. Results are whole and exact; nothing is
dropped, and no group meets in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.sizing import broadcast_if_few, fits_one_task
from tidemark.sources.scratch import frozen

# Rows of one group that a single task is trusted to sort.
GROUP_ROWS = 2_000_000

BLOCK = "_block"
CARRY = "_carry"
ROW_IN_BLOCK = "_row_in_block"


@dataclass(frozen=True)
class Limits:
    """When a group counts as too large.

    ``one_task_bytes``: inputs estimated at or below this are not even counted.
    ``group_rows``: larger groups are cut into blocks of about this many rows.
    """

    one_task_bytes: int | None = None
    group_rows: int = GROUP_ROWS


@dataclass(frozen=True)
class Split:
    """The rows of a frame by the size of their group."""

    ordinary: DataFrame
    oversized: DataFrame | None
    oversized_rows: int
    keys: list[str]
    group_rows: int

    @property
    def blocks(self) -> int:
        return math.ceil(self.oversized_rows / self.group_rows) + 1


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality on all keys where NULL equals NULL, as in a window partition."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def split_by_group_size(df: DataFrame, keys: list[str], limits: Limits) -> Split:
    """Separate the groups of more than ``limits.group_rows`` rows.

    Counting reads the key columns only and combines before its shuffle. There
    are at most ``rows / group_rows`` oversized groups.
    """
    plain = Split(df, None, 0, keys, limits.group_rows)
    known_small = (
        fits_one_task(df)
        if limits.one_task_bytes is None
        else fits_one_task(df, limits.one_task_bytes)
    )
    if known_small:
        return plain
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = frozen(counts.filter(F.col("_rows") > limits.group_rows), "large-groups")
    groups, rows = large.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    if groups == 0:
        return plain
    marked = broadcast_if_few(large.select(*keys), groups)
    on = same_keys(df, marked, keys)
    return Split(
        ordinary=df.join(marked, on, "left_anti"),
        oversized=df.join(marked, on, "left_semi"),
        oversized_rows=rows,
        keys=keys,
        group_rows=limits.group_rows,
    )


def in_blocks(split: Split, order: list[Column], within: Callable[[Window], dict[str, Column]]) -> DataFrame:
    """Cut the oversized groups into blocks and evaluate columns inside each.

    ``order`` must be a total order of the group (end it with a unique column),
    so that any run of equal values can be cut too. ``within`` gets the window of
    one block (partitioned, not ordered) and returns the columns to add.

    The result is written once: the range boundaries come from a sample, and the
    written table fixes them for the summary and for the rows alike.
    """
    ranged = split.oversized.repartitionByRange(split.blocks, *map(F.col, split.keys), *order)
    numbered = ranged.withColumn(BLOCK, F.spark_partition_id())
    block = Window.partitionBy(*split.keys, BLOCK)
    columns = within(block)
    columns[ROW_IN_BLOCK] = F.row_number().over(block.orderBy(*order))
    return frozen(numbered.withColumns(columns), "blocks")


def summarise(split: Split, rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row per block. A block lies in one write task, so it combines there."""
    return rows.groupBy(*split.keys, BLOCK).agg(*(c.alias(n) for n, c in measures.items()))


def attach(split: Split, rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Give every row the carry of its block, as one struct (see ``carried``).

    There are fewer than two summaries per range partition, a bound known before
    the join. Beyond the broadcast limit the join shuffles on key and block, and
    no block is larger than a task can hold.
    """
    on_columns = [*split.keys, BLOCK]
    values = F.struct(*(c for c in carry.columns if c not in on_columns)).alias(CARRY)
    named = carry.select(*(F.col(c).alias(f"_of_{c}") for c in on_columns), values)
    few = broadcast_if_few(named, 2 * split.blocks)
    on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on_columns))
    return rows.join(few, on, "left").drop(*(f"_of_{c}" for c in on_columns))


def carried(name: str) -> Column:
    """A carried value, after ``attach``."""
    return F.col(f"{CARRY}.{name}")


def block_order(split: Split) -> Window:
    """The blocks of one group in order."""
    return Window.partitionBy(*split.keys).orderBy(BLOCK)
