"""Map, flat map and reduce by key, as frames; and their RDD forms.

The frame forms stay in the JVM and combine before the shuffle. The RDD forms
are for callers who hold an RDD; they give the same rows.
"""

from __future__ import annotations

import re
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import double_or_null
from tidemark.functions.money import money_sum
from tidemark.functions.text import BLANKS, words
from tidemark.plans.sizing import spread_if_small
from tidemark.sources.clicks import PURCHASE
from tidemark.sources.readers import with_json_object


def map_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """One row in, one row out."""
    return df.select(*(c.alias(n) for n, c in columns.items()))


def flat_map(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One row per element of an array expression."""
    return df.select(F.explode(items).alias(name))


def reduce_by_key(df: DataFrame, key: str, value: Column, name: str = "value") -> DataFrame:
    """Sum per key."""
    return df.groupBy(key).agg(F.sum(value).alias(name))


def word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """How often each lower-case word occurs."""
    spread = spread_if_small(texts.select(column))
    return flat_map(spread, words(column), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_rdd(texts: DataFrame, column: str = "text") -> DataFrame:
    """The same through map and reduce over an RDD."""
    blank = re.compile(BLANKS)
    counts = (
        spread_if_small(texts.select(F.lower(column))).rdd
        .flatMap(lambda row: [w for w in blank.split(row[0]) if w] if row[0] else [])
        .map(lambda word: (word, 1))
        .reduceByKey(add)
    )
    return texts.sparkSession.createDataFrame(counts, "word string, n long")


def rows_and_back(df: DataFrame) -> DataFrame:
    """Frame to RDD of rows and back, with the schema given rather than inferred."""
    return df.sparkSession.createDataFrame(df.rdd, df.schema)


def revenue_by_category(lines: DataFrame, column: str = "value") -> DataFrame:
    """Purchase revenue per category from raw JSON lines.

    Lines that are not JSON are skipped, as are purchases without an amount or
    with amount 0. A record without category counts as ``Unknown``.
    """
    amount = double_or_null("total_amount")
    sales = (
        with_json_object(lines, column, ["event_type", "category", "total_amount"], "record")
        .select("record.*")
        .filter(F.col("event_type") == PURCHASE)
        .select(F.coalesce("category", F.lit("Unknown")).alias("category"), amount.alias("amount"))
        .filter(F.col("amount").isNotNull() & (F.col("amount") != 0))
    )
    return sales.groupBy("category").agg(money_sum("amount").alias("revenue"))


def purchases_per_device(frame: DataFrame) -> DataFrame:
    return (
        frame.filter(F.col("event_type") == PURCHASE)
        .groupBy("device")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def purchases_per_device_rdd(frame: DataFrame) -> DataFrame:
    """The same through filter, map and reduce over an RDD."""
    counts = (
        frame.select("event_type", "device").rdd
        .filter(lambda row: row["event_type"] == PURCHASE)
        .map(lambda row: (row["device"], 1))
        .reduceByKey(add)
    )
    return frame.sparkSession.createDataFrame(counts, "device string, n long")
