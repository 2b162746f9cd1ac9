"""Exact distinct counts, several at a time, without multiplying the rows.

Spark plans several distinct counts of one aggregate by making a copy of every row
for each of them before the first shuffle. Here each distinct column has a plan of
its own that reads that column and the keys only, and whose map side already keeps
one row per key and value, or per key and block of ids:

* any column: group by key and value, then count the values of each key;
* whole numbers that lie close together: a bitmap of 32,768 ids per key and block.
  Bitmaps can be stored and merged, so that a count over a month comes from the
  bitmaps of its days without a look at the rows.

The parts meet as one row per key each. A key with a third of all rows is combined
on the map side like any other; its values are spread by key and value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BLOCK = "id_block"
IDS = "ids"


def distinct_of(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Distinct non-NULL values per key, by grouping on key and value. Keys without a value have no row."""
    rows = df.select(*keys, value.alias(name)).filter(F.col(name).isNotNull())
    return rows.distinct().groupBy(*keys).agg(F.count(name).alias(name))


def id_bitmaps(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The distinct ids of each key as bitmaps: keys, ``id_block``, ``ids``. Ids must be whole numbers."""
    if not isinstance(df.schema[column].dataType, IntegralType):
        raise ValueError(f"{column} does not hold whole numbers")
    ids = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("long").alias("_id"))
    blocks = ids.groupBy(*keys, F.bitmap_bucket_number("_id").alias(BLOCK))
    return blocks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias(IDS))


def merged_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps per coarser key (some of the keys, or others derived from them)."""
    return bitmaps.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(IDS).alias(IDS))


def distinct_from(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Exact number of distinct ids per key, from bitmaps of any finer keys."""
    once = merged_bitmaps(bitmaps, keys)
    return once.groupBy(*keys).agg(F.sum(F.bitmap_count(IDS)).alias(name))


def measured(df: DataFrame, keys: list[str], measures: dict[str, Column], distinct: dict[str, Column]) -> DataFrame:
    """One aggregate with several distinct counts: keys, ``measures``, then ``distinct`` (0 where there is no value).

    ``measures`` are ordinary aggregates without a distinct count; ``distinct`` maps a
    result to the column whose values are counted (a condition goes into it by ``F.when``).
    """
    present = "_present"
    parts = [df.groupBy(*keys).agg(F.lit(True).alias(present), *(c.alias(n) for n, c in measures.items()))]
    parts += [distinct_of(df, keys, value, name) for name, value in distinct.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # Every result stands in one of the parts only. The part with the measures has every key.
    whole = F.max_by(F.struct(*measures), F.col(present)).alias("_measures") if measures else F.max(present).alias("_measures")
    rows = stacked.groupBy(*keys).agg(whole, *(F.coalesce(F.max(n), F.lit(0).cast("long")).alias(n) for n in distinct))
    return rows.select(*keys, *(F.col(f"_measures.{n}").alias(n) for n in measures), *distinct)
