"""Bronze, Silver and Gold: from raw JSON lines to business tables.

Every function maps frames to frames; ``build_layers`` at the end runs them over
stored tables. The run time is an argument, so a repeated run gives the same
rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import user_segment
from tidemark.functions.casts import (
    double_or_null,
    flag,
    int_or_null,
    normal_text,
    timestamp_or_null,
)
from tidemark.functions.money import money_sum, money_sum_or_zero, percent, ratio, representable, round2
from tidemark.operators.aggregates import count_where, first_in_group
from tidemark.sources.clicks import PURCHASE
from tidemark.sources.readers import read_required, with_json_object
from tidemark.sources.schemas import RAW_FIELDS
from tidemark.sources.sinks import write_parquet

# What the layers write into their own columns.
SOURCE = "raw_clickstream_feed"
VALID = "valid"
PARSE_ERROR = "parse_error"
PARSE_ERROR_CODE = "MALFORMED_JSON"
BRONZE_COLUMNS = [
    "_bronze_ingestion_time",
    "_bronze_source",
    "_bronze_status",
    "_bronze_error",
    "_bronze_raw_data",
]
SILVER_COLUMNS = [
    "event_id", "event_timestamp", "event_date", "event_hour", "day_of_week", "user_id",
    "event_type", "device", "country", "session_id", "product_id", "category", "price",
    "quantity", "total_amount", "_silver_processed_time",
]

# --- Bronze ---------------------------------------------------------------------


def bronze(lines: DataFrame, ingested_at: str, column: str = "value", source: str = SOURCE) -> DataFrame:
    """Parse JSON lines and add where they came from. No line is lost.

    A line that is not a JSON object becomes a row with status ``parse_error``
    and its text. Fields are read as text first: a word in a number field gives
    a NULL in that field, not a parse error.
    """
    raw = lines.select(F.col(column).alias("_raw"))
    parsed = with_json_object(raw, "_raw", [name for name, _ in RAW_FIELDS], "_e")
    failed = F.col("_e").isNull()
    fields = [F.col(f"_e.{name}").try_cast(kind).alias(name) for name, kind in RAW_FIELDS]
    return parsed.select(
        *fields,
        F.lit(ingested_at).alias("_bronze_ingestion_time"),
        F.lit(source).alias("_bronze_source"),
        F.when(failed, PARSE_ERROR).otherwise(VALID).alias("_bronze_status"),
        F.when(failed, PARSE_ERROR_CODE).alias("_bronze_error"),
        F.col("_raw").alias("_bronze_raw_data"),
    )


def status_counts(bronze_table: DataFrame) -> DataFrame:
    return bronze_table.groupBy("_bronze_status").agg(F.count(F.lit(1)).alias("n"))


# --- Silver ---------------------------------------------------------------------


def cleaned(bronze_table: DataFrame, processed_at: str) -> DataFrame:
    """Parsed records with typed, normalised fields and the validity flag.

    A record is valid when user, time and type are all known and its amount, if
    any, is one that sums can hold.
    """
    parsed = bronze_table.filter(F.col("_bronze_status") == VALID)
    return (
        parsed.withColumns(
            {
                "event_timestamp": timestamp_or_null("timestamp"),
                "user_id_clean": int_or_null("user_id"),
                "device": normal_text("device"),
                "country": normal_text("country", "upper"),
                "event_type": normal_text("event_type"),
                "price": double_or_null("price"),
                "quantity": int_or_null("quantity"),
                "total_amount": double_or_null("total_amount"),
                "_silver_processed_time": F.lit(processed_at),
            }
        )
        .withColumns(
            {
                "event_date": F.to_date("event_timestamp"),
                "event_hour": F.hour("event_timestamp"),
                "day_of_week": F.dayofweek("event_timestamp"),
                "_silver_is_valid": flag(
                    F.col("user_id_clean").isNotNull()
                    & F.col("event_timestamp").isNotNull()
                    & F.col("event_type").isNotNull()
                    & representable("total_amount")
                ),
            }
        )
    )


def silver(clean: DataFrame) -> DataFrame:
    """The valid records, in the sixteen published columns."""
    typed = clean.filter(F.col("_silver_is_valid")).withColumn("user_id", F.col("user_id_clean"))
    return typed.select(*SILVER_COLUMNS)


def quarantine(clean: DataFrame) -> DataFrame:
    """The records that are not valid, with all working columns."""
    return clean.filter(~F.col("_silver_is_valid"))


def silver_report(clean: DataFrame) -> DataFrame:
    """One row: total, valid and invalid records and their shares."""
    counts = clean.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("_silver_is_valid").alias("valid"),
        F.count_if(~F.col("_silver_is_valid")).alias("invalid"),
    )
    return counts.withColumns(
        {
            "valid_pct": F.round(percent("valid", "total"), 1),
            "invalid_pct": F.round(percent("invalid", "total"), 1),
        }
    )


# --- Gold -----------------------------------------------------------------------
# The names of the result columns are the stored schema of the Gold tables.


def _purchase() -> Column:
    return F.col("event_type") == PURCHASE


def daily_metrics(events: DataFrame) -> DataFrame:
    """Per day. ``conversion_rate`` is purchases per hundred users and may exceed 100."""
    per_day = events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
        count_where(_purchase()).alias("num_purchases"),
        money_sum_or_zero("total_amount", _purchase()).alias("daily_revenue"),
    )
    return per_day.withColumns(
        {
            "conversion_rate": round2(percent("num_purchases", "unique_users")),
            "avg_order_value": round2(ratio("daily_revenue", "num_purchases")),
        }
    )


def user_metrics(events: DataFrame) -> DataFrame:
    """Per user. ``primary_device`` is the device of the earliest event.

    The device is found in an aggregate of its own: kept with the distinct counts
    it would turn them, and the rows they multiply, from hashing to sorting. The
    join moves one row per user.
    """
    per_user = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_distinct("event_date").alias("active_days"),
        F.min("event_timestamp").alias("first_seen"),
        F.max("event_timestamp").alias("last_seen"),
        count_where(_purchase()).alias("num_purchases"),
        money_sum_or_zero("total_amount", _purchase()).alias("total_spent"),
    )
    device = events.groupBy(F.col("user_id").alias("_user")).agg(
        first_in_group("device", "event_timestamp", "event_id").alias("primary_device")
    )
    joined = per_user.join(device, F.col("user_id").eqNullSafe(F.col("_user"))).drop("_user")
    return joined.withColumn("user_segment", user_segment("total_spent"))


def segment_counts(events: DataFrame) -> DataFrame:
    """Users per segment. Spend per user decides, so neither distinct counts nor devices are needed."""
    spent = events.groupBy("user_id").agg(money_sum_or_zero("total_amount", _purchase()).alias("total_spent"))
    return spent.groupBy(user_segment("total_spent").alias("user_segment")).agg(F.count(F.lit(1)).alias("users"))


def product_metrics(events: DataFrame) -> DataFrame:
    """Per product and category, for events that concern a product."""
    return (
        events.filter(F.col("product_id").isNotNull())
        .groupBy("product_id", "category")
        .agg(
            F.count(F.lit(1)).alias("total_interactions"),
            count_where(_purchase()).alias("purchases"),
            money_sum_or_zero("total_amount", _purchase()).alias("revenue"),
            F.count_distinct("user_id").alias("unique_users"),
        )
    )


def category_metrics(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            count_where(_purchase()).alias("num_purchases"),
            round2(money_sum_or_zero("total_amount", _purchase())).alias("total_revenue"),
            F.count_distinct("user_id").alias("unique_customers"),
        )
    )


GOLD = {
    "daily_metrics": daily_metrics,
    "user_metrics": user_metrics,
    "product_metrics": product_metrics,
    "category_metrics": category_metrics,
}


# --- run over storage -----------------------------------------------------------


@dataclass(frozen=True)
class Layers:
    """Where the tables of one run lie, and the row counts seen while they were written."""

    root: str
    counts: dict[str, int] | None = field(default=None, compare=False)

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/events"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/events"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/silver/quarantine"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def write_bronze(lines: DataFrame, at: Layers, run_time: str) -> dict:
    """Write Bronze and return its row counts, observed during the write."""
    seen = Observation()
    table = bronze(lines, run_time).observe(
        seen,
        F.count(F.lit(1)).alias("bronze_records"),
        F.count_if(F.col("_bronze_status") == PARSE_ERROR).alias("parse_errors"),
    )
    write_parquet(table, at.bronze)
    return dict(seen.get)


def write_silver(spark: SparkSession, at: Layers, run_time: str) -> dict:
    """Write the valid and the quarantined records and return both counts.

    Each write scans Bronze once. Both steps are narrow, so reading the columnar
    table again costs less than keeping a copy of it in memory.
    """
    clean = cleaned(read_required(spark, at.bronze, "write_bronze"), run_time)
    counts = {}
    for name, table, path in (
        ("silver_records", silver(clean), at.silver),
        ("quarantine_records", quarantine(clean), at.quarantine),
    ):
        seen = Observation()
        write_parquet(table.observe(seen, F.count(F.lit(1)).alias(name)), path)
        counts.update(seen.get)
    return counts


def write_gold(spark: SparkSession, at: Layers) -> dict:
    """Write the four Gold tables at the same time and return their row counts.

    Each reads only the Silver columns it uses; their jobs share the executors.
    """
    events = read_required(spark, at.silver, "write_silver")

    def write(name: str) -> tuple[str, int]:
        seen = Observation()
        write_parquet(GOLD[name](events).observe(seen, F.count(F.lit(1)).alias("n")), at.gold(name))
        return name, seen.get["n"]

    with ThreadPoolExecutor(len(GOLD)) as pool:
        return dict(pool.map(write, GOLD))


def layer_summary(spark: SparkSession, at: Layers) -> DataFrame:
    """One row over the stored tables: layer counts, quality rate and totals.

    Records with parse errors are in neither Silver nor quarantine, but count in
    the quality rate. Counts that the run saw are taken from it, others are made.
    """
    known = at.counts or {}

    def n(path: str, name: str) -> DataFrame:
        if name in known:
            return spark.range(1).select(F.lit(known[name]).cast("long").alias(name))
        return read_required(spark, path, "build_layers").agg(F.count(F.lit(1)).alias(name))

    totals = read_required(spark, at.gold("daily_metrics"), "write_gold").agg(
        money_sum("daily_revenue").alias("total_revenue"),
        F.sum("num_purchases").alias("total_purchases"),
    )
    # One row each, stacked side by side.
    parts = [
        n(at.bronze, "bronze_records"),
        n(at.silver, "silver_records"),
        n(at.quarantine, "quarantine_records"),
        totals,
        n(at.gold("user_metrics"), "total_users"),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns)).select(
        "bronze_records",
        "silver_records",
        "quarantine_records",
        F.round(percent("silver_records", "bronze_records"), 1).alias("data_quality_rate"),
        "total_revenue",
        "total_purchases",
        "total_users",
        F.coalesce(round2(ratio("total_revenue", "total_purchases")), F.lit(0.0)).alias("avg_order_value"),
    )


def build_layers(lines: DataFrame, root: str, run_time: str) -> Layers:
    """Bronze, Silver and Gold in order. A step that fails ends the run."""
    spark, at = lines.sparkSession, Layers(root)
    counts = write_bronze(lines, at, run_time) | write_silver(spark, at, run_time)
    counts["total_users"] = write_gold(spark, at)["user_metrics"]
    return replace(at, counts=counts)
