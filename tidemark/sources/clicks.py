"""The clickstream as the operators expect it, projected from ``events``.

``events`` holds an id, a time, a user, a type, a value and a small JSON text
with one number ``k``. The missing columns follow from these by rule, so the
projection stays inside one scan and its filters reach the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casts import bit
from tidemark.sources.readers import local_table, read_table
from tidemark.sources.schemas import (
    CATEGORIES,
    CATEGORY_ROWS,
    CATEGORY_SCHEMA,
    COUNTRIES,
    DEVICES,
)

# Event types that concern a product, and the one that is paid.
PRODUCT_EVENTS = ["view", "click", "purchase"]
PURCHASE = "purchase"


def _pick(names: list[str], index: Column) -> Column:
    """The name at ``index`` of a fixed list."""
    return F.element_at(F.array(*map(F.lit, names)), (index + 1).cast("int"))


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    return project_clicks(read_table(spark, folder, "events"))


def project_clicks(events: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    on_product = F.col("event_type").isin(PRODUCT_EVENTS)
    paid = F.col("event_type") == PURCHASE
    quantity = 1 + k % 5
    return events.select(
        "event_id",
        F.col("ts").alias("event_timestamp"),
        F.to_date("ts").alias("event_date"),
        F.hour("ts").alias("event_hour"),
        F.dayofweek("ts").alias("day_of_week"),
        "user_id",
        "event_type",
        _pick(DEVICES, k % len(DEVICES)).alias("device"),
        _pick(COUNTRIES, F.col("user_id") % len(COUNTRIES)).alias("country"),
        F.concat_ws("_", F.lit("sess"), F.col("user_id"), k % 5).alias("session_id"),
        F.when(on_product, F.concat(F.lit("prod_"), k)).alias("product_id"),
        F.when(on_product, _pick(CATEGORIES, k % len(CATEGORIES))).alias("category"),
        F.when(on_product, F.col("value")).alias("price"),
        F.when(paid, quantity).alias("quantity"),
        F.when(paid, F.round(F.col("value") * quantity, 2)).alias("total_amount"),
    )


def purchases(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col("event_type") == PURCHASE)


def paid_purchases(frame: DataFrame) -> DataFrame:
    return purchases(frame).filter(F.col("total_amount").isNotNull())


def with_hour_buckets(frame: DataFrame) -> DataFrame:
    """The shared input of the reuse operators: product events with two flags."""
    from tidemark.functions.buckets import hour_bucket

    return frame.filter(F.col("event_type").isin(PRODUCT_EVENTS)).withColumns(
        {
            "is_purchase": bit(F.col("event_type") == PURCHASE),
            "hour_bucket": hour_bucket("event_hour"),
        }
    )


def category_dimension(spark: SparkSession) -> DataFrame:
    return local_table(spark, CATEGORY_ROWS, CATEGORY_SCHEMA)


def raw_records(frame: DataFrame) -> DataFrame:
    """The clicks as raw JSON lines, some of them spoiled.

    Every 97th record is cut short, every 61st has a bad user, every 67th a bad
    time (first match wins); in every 5th device and country
    are padded and in the wrong case.
    """
    n = F.col("event_id")
    untidy = n % 5 == 0
    text = F.to_json(
        F.struct(
            n.cast("string").alias("event_id"),
            F.when((n % 67 == 0) & (n % 61 != 0), "not-a-date")
            .otherwise(F.col("event_timestamp").cast("string"))
            .alias("timestamp"),
            F.when(n % 61 == 0, "invalid")
            .otherwise(F.col("user_id").cast("string"))
            .alias("user_id"),
            "event_type",
            F.when(untidy, F.concat(F.lit(" "), F.upper("device"), F.lit(" ")))
            .otherwise(F.col("device"))
            .alias("device"),
            F.when(untidy, F.concat(F.lit(" "), F.lower("country")))
            .otherwise(F.col("country"))
            .alias("country"),
            "session_id",
            "product_id",
            "category",
            "price",
            "quantity",
            "total_amount",
        )
    )
    cut = F.expr("left(text, 20)")
    return frame.select(n, text.alias("text")).select(
        F.when(n % 97 == 0, cut).otherwise(F.col("text")).alias("value")
    )
