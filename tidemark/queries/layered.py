"""Bronze, Silver and Gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import layers
from tidemark.operators.relational import stacked
from tidemark.queries.registry import CLICKS, RECORDS, money, query, rounded
from tidemark.queries.relational import RUN_TIME
from tidemark.sources.clicks import clicks, raw_records
from tidemark.sources.readers import read_required
from tidemark.sources.scratch import fresh_dir, frozen


def _bronze(spark, sf):
    return layers.bronze(raw_records(clicks(spark, sf)), RUN_TIME)


def _clean(spark, sf):
    return layers.cleaned(_bronze(spark, sf), RUN_TIME)


def _silver(spark, sf):
    return layers.silver(_clean(spark, sf))


@query(
    f"""{CLICKS}, b AS (SELECT *, event_id % 97 = 0 AS failed FROM clicks)
  SELECT CASE WHEN NOT failed THEN cast(event_id AS varchar) END AS event_id, CASE WHEN NOT failed THEN event_type END AS event_type,
    CASE WHEN NOT failed THEN total_amount END AS total_amount, '{RUN_TIME}' AS _bronze_ingestion_time,
    'raw_clickstream_feed' AS _bronze_source, CASE WHEN failed THEN 'parse_error' ELSE 'valid' END AS _bronze_status,
    CASE WHEN failed THEN 'MALFORMED_JSON' END AS _bronze_error, failed AS cut_short FROM b"""
)
def med_01_bronze(spark, sf):
    return _bronze(spark, sf).select(
        "event_id", "event_type", "total_amount", "_bronze_ingestion_time", "_bronze_source", "_bronze_status",
        "_bronze_error", (F.length("_bronze_raw_data") == 20).alias("cut_short"),
    )


@query(
    "SELECT CASE WHEN event_id % 97 = 0 THEN 'parse_error' ELSE 'valid' END AS _bronze_status, count(*) AS n FROM events GROUP BY 1"
)
def med_02_status_counts(spark, sf):
    return layers.status_counts(_bronze(spark, sf))


@query(
    f"""{RECORDS} SELECT cast(event_id AS varchar) AS event_id, CASE WHEN NOT bad_time THEN event_timestamp END AS event_timestamp,
    CASE WHEN NOT bad_time THEN event_date END AS event_date, CASE WHEN NOT bad_time THEN event_hour END AS event_hour,
    CASE WHEN NOT bad_time THEN day_of_week END AS day_of_week, CASE WHEN NOT bad_user THEN cast(user_id AS int) END AS user_id_clean,
    event_type, device, country, price, quantity, total_amount FROM records"""
)
def med_03_clean(spark, sf):
    return _clean(spark, sf).select(
        "event_id", "event_timestamp", "event_date", "event_hour", "day_of_week", "user_id_clean", "event_type",
        "device", "country", "price", "quantity", "total_amount",
    )


@query(f"{RECORDS} SELECT cast(event_id AS varchar) AS event_id, NOT bad_user AND NOT bad_time AS _silver_is_valid FROM records")
def med_04_validity(spark, sf):
    return _clean(spark, sf).select("event_id", "_silver_is_valid")


@query(
    f"""{RECORDS} SELECT CASE WHEN bad_user OR bad_time THEN 'quarantine' ELSE 'silver' END AS layer, cast(event_id AS varchar) AS event_id,
    CASE WHEN bad_user THEN 'invalid' ELSE cast(user_id AS varchar) END AS user_id, device FROM records"""
)
def med_05_split(spark, sf):
    clean = _clean(spark, sf)
    valid, bad = layers.silver(clean), layers.quarantine(clean)
    return stacked(
        valid.select(F.lit("silver").alias("layer"), "event_id", F.col("user_id").cast("string").alias("user_id"), "device"),
        bad.select(F.lit("quarantine").alias("layer"), "event_id", "user_id", "device"),
    )


@query(
    f"""{RECORDS}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE NOT bad_user AND NOT bad_time) AS valid FROM records)
  SELECT total, valid, total - valid AS invalid, {rounded('cast(valid AS double) / total * 100', 1)} AS valid_pct,
    {rounded('cast(total - valid AS double) / total * 100', 1)} AS invalid_pct FROM c"""
)
def med_06_silver_report(spark, sf):
    return layers.silver_report(_clean(spark, sf))


_PAID_SUM = money("CASE WHEN event_type = 'purchase' THEN total_amount ELSE 0 END")
_PAID_COUNT = "count(*) FILTER (WHERE event_type = 'purchase')"

DAILY = f"""daily AS (SELECT event_date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
    count(DISTINCT session_id) AS unique_sessions, {_PAID_COUNT} AS num_purchases, {_PAID_SUM} AS daily_revenue
  FROM {{}} GROUP BY event_date)
  SELECT *, {rounded('cast(num_purchases AS double) / unique_users * 100')} AS conversion_rate,
    {rounded('daily_revenue / nullif(num_purchases, 0)')} AS avg_order_value FROM daily"""


@query(f"{RECORDS}, {DAILY.format('silver')}")
def med_07_daily_metrics(spark, sf):
    return layers.daily_metrics(_silver(spark, sf)).orderBy("event_date")


_USERS = f"""users AS (SELECT cast(user_id AS int) AS user_id, count(*) AS total_events, count(DISTINCT session_id) AS total_sessions,
    count(DISTINCT event_date) AS active_days, min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen,
    {_PAID_COUNT} AS num_purchases, {_PAID_SUM} AS total_spent, arg_min(device, event_timestamp) AS primary_device
  FROM silver GROUP BY user_id)"""
_SEGMENT = (
    "CASE WHEN total_spent > 500 THEN 'High Value' WHEN total_spent > 100 THEN 'Medium Value' "
    "WHEN total_spent > 0 THEN 'Low Value' ELSE 'Non-Purchaser' END"
)


@query(f"{RECORDS}, {_USERS} SELECT *, {_SEGMENT} AS user_segment FROM users")
def med_08_user_metrics(spark, sf):
    # Read twice, so stored rather than parsed twice.
    return layers.user_metrics(frozen(_silver(spark, sf), "silver")).orderBy(F.desc("total_spent"), F.asc("user_id"))


@query(f"{RECORDS}, {_USERS} SELECT {_SEGMENT} AS user_segment, count(*) AS users FROM users GROUP BY 1")
def med_09_segments(spark, sf):
    return layers.segment_counts(_silver(spark, sf))


@query(
    f"""{RECORDS} SELECT product_id, category, count(*) AS total_interactions, {_PAID_COUNT} AS purchases, {_PAID_SUM} AS revenue,
    count(DISTINCT user_id) AS unique_users FROM silver WHERE product_id IS NOT NULL GROUP BY product_id, category"""
)
def med_10_product_metrics(spark, sf):
    return layers.product_metrics(_silver(spark, sf)).orderBy(F.desc("revenue"), F.asc("product_id"))


@query(
    f"""{RECORDS} SELECT category, count(*) AS total_events, {_PAID_COUNT} AS num_purchases, {_PAID_SUM} AS total_revenue,
    count(DISTINCT user_id) AS unique_customers FROM silver WHERE category IS NOT NULL GROUP BY category"""
)
def med_11_category_metrics(spark, sf):
    return layers.category_metrics(_silver(spark, sf)).orderBy(F.desc("total_revenue"), F.asc("category"))


@query(
    f"""{RECORDS}, t AS (SELECT (SELECT count(*) FROM events) AS bronze_records, (SELECT count(*) FROM silver) AS silver_records,
    (SELECT count(*) FROM records WHERE bad_user OR bad_time) AS quarantine_records,
    (SELECT {_PAID_SUM} FROM silver) AS total_revenue, (SELECT {_PAID_COUNT} FROM silver) AS total_purchases,
    (SELECT count(DISTINCT user_id) FROM silver) AS total_users)
  SELECT bronze_records, silver_records, quarantine_records,
    {rounded('cast(silver_records AS double) / bronze_records * 100', 1)} AS data_quality_rate, total_revenue, total_purchases, total_users,
    coalesce({rounded('total_revenue / nullif(total_purchases, 0)')}, 0.0) AS avg_order_value FROM t"""
)
def med_12_summary(spark, sf):
    at = layers.build_layers(raw_records(clicks(spark, sf)), fresh_dir(spark, "layers"), RUN_TIME)
    return layers.layer_summary(spark, at)


@query(
    f"""{RECORDS} SELECT 'bronze' AS stored, count(*) AS n FROM events UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'quarantine', count(*) FROM records WHERE bad_user OR bad_time
  UNION ALL SELECT 'daily_metrics', count(DISTINCT event_date) FROM silver
  UNION ALL SELECT 'user_metrics', count(DISTINCT user_id) FROM silver
  UNION ALL SELECT 'product_metrics', count(DISTINCT product_id) FROM silver
  UNION ALL SELECT 'category_metrics', count(DISTINCT category) FROM silver"""
)
def med_13_layered_run(spark, sf):
    at = layers.build_layers(raw_records(clicks(spark, sf)), fresh_dir(spark, "layers"), RUN_TIME)
    stored = {
        "bronze": at.bronze,
        "silver": at.silver,
        "quarantine": at.quarantine,
        **{name: at.gold(name) for name in layers.GOLD},
    }
    return stacked(
        *(
            read_required(spark, path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stored"), "n")
            for name, path in stored.items()
        )
    )


# The flagship query: daily metrics straight from the clickstream.
FLAGSHIP_SQL = f"{CLICKS}, {DAILY.format('clicks')}"


@query(FLAGSHIP_SQL)
def daily_conversion(spark, sf):
    return layers.daily_metrics(clicks(spark, sf)).orderBy("event_date")
