"""Projections, filters, NULLs, scalar functions, distinct, union, sort and limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import hour_bucket
from tidemark.functions.casts import (
    bit,
    double_or_null,
    epoch_seconds,
    flag,
    int_or_null,
    normal_text,
    timestamp_or_null,
)
from tidemark.functions.money import percent, round2
from tidemark.functions.text import words
from tidemark.operators import relational as rel
from tidemark.operators.windows import neighbours
from tidemark.queries.registry import CLICKS, RECORDS, WORDS, query, rounded
from tidemark.sources.clicks import PURCHASE, clicks, raw_records
from tidemark.sources.readers import parse_json, read_table
from tidemark.sources.schemas import RAW_EVENT_TEXT

RUN_TIME = "2024-02-01T00:00:00"


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw JSON lines with every field read as text; unreadable lines are left out."""
    return parse_json(raw_records(clicks(spark, sf)), RAW_EVENT_TEXT).filter(F.col("event_id").isNotNull())


# --- projections ----------------------------------------------------------------


@query(f"{CLICKS} SELECT event_id, user_id, event_type, device FROM clicks")
def prj_01_project(spark, sf):
    return clicks(spark, sf).select("event_id", "user_id", "event_type", "device")


@query(f"{CLICKS} SELECT event_id, user_id, event_type AS action, device FROM clicks")
def prj_02_rename(spark, sf):
    return clicks(spark, sf).select("event_id", "user_id", F.col("event_type").alias("action"), "device")


@query("SELECT *, cast(ts AS date) AS event_date FROM events")
def prj_03_all_plus(spark, sf):
    return read_table(spark, sf, "events").select("*", F.to_date("ts").alias("event_date"))


@query(
    f"{CLICKS} SELECT event_id, upper(device) AS device, cast(event_type = 'purchase' AS int) AS is_purchase, "
    "coalesce(price, 0) * coalesce(quantity, 1) AS line_value FROM clicks"
)
def prj_04_add_columns(spark, sf):
    return (
        clicks(spark, sf)
        .withColumns(
            {
                "device": F.upper("device"),
                "is_purchase": bit(F.col("event_type") == PURCHASE),
                "line_value": F.coalesce("price", F.lit(0.0)) * F.coalesce("quantity", F.lit(1)),
            }
        )
        .select("event_id", "device", "is_purchase", "line_value")
    )


@query(
    f"{CLICKS} SELECT event_id, event_type = 'purchase' AS is_purchase, "
    "coalesce(total_amount > 100, false) AS is_large, CASE WHEN total_amount > 100 THEN 1 ELSE 0 END AS large_bit FROM clicks"
)
def prj_05_flags(spark, sf):
    large = F.col("total_amount") > 100
    return clicks(spark, sf).select(
        "event_id",
        flag(F.col("event_type") == PURCHASE).alias("is_purchase"),
        flag(large).alias("is_large"),
        bit(large).alias("large_bit"),
    )


# --- filters --------------------------------------------------------------------

_SHOWN = "event_id, event_type, device, total_amount"
_COLUMNS = _SHOWN.split(", ")


@query(f"{CLICKS} SELECT {_SHOWN} FROM clicks WHERE event_type = 'purchase'")
def flt_01_equals(spark, sf):
    return clicks(spark, sf).filter(F.col("event_type") == PURCHASE).select(*_COLUMNS)


@query(f"{CLICKS} SELECT {_SHOWN} FROM clicks WHERE event_type = 'purchase' AND device = 'mobile'")
def flt_02_and(spark, sf):
    return (
        clicks(spark, sf)
        .filter((F.col("event_type") == PURCHASE) & (F.col("device") == "mobile"))
        .select(*_COLUMNS)
    )


@query(f"{CLICKS} SELECT {_SHOWN} FROM clicks WHERE event_type = 'click' OR event_type = 'signup'")
def flt_03_or(spark, sf):
    return (
        clicks(spark, sf)
        .filter((F.col("event_type") == "click") | (F.col("event_type") == "signup"))
        .select(*_COLUMNS)
    )


@query(f"{CLICKS} SELECT {_SHOWN} FROM clicks WHERE event_type IN ('purchase', 'click', 'view')")
def flt_04_in(spark, sf):
    return clicks(spark, sf).filter(F.col("event_type").isin("purchase", "click", "view")).select(*_COLUMNS)


@query(f"{CLICKS} SELECT {_SHOWN} FROM clicks WHERE total_amount IS NOT NULL AND total_amount > 100")
def flt_05_range(spark, sf):
    amount = F.col("total_amount")
    return clicks(spark, sf).filter(amount.isNotNull() & (amount > 100)).select(*_COLUMNS)


@query(
    f"{CLICKS} SELECT count(*) FILTER (WHERE price IS NULL) AS without_price, "
    "count(*) FILTER (WHERE price IS NOT NULL) AS with_price FROM clicks"
)
def flt_06_null_tests(spark, sf):
    price = F.col("price")
    return clicks(spark, sf).agg(
        F.count_if(price.isNull()).alias("without_price"),
        F.count_if(price.isNotNull()).alias("with_price"),
    )


@query(
    f"{CLICKS} SELECT event_id, total_amount > 100 AS is_large FROM clicks "
    "WHERE event_type = 'purchase' AND NOT (coalesce(total_amount > 100, false))"
)
def flt_07_boolean(spark, sf):
    flagged = clicks(spark, sf).withColumn("is_large", flag(F.col("total_amount") > 100))
    return flagged.filter(F.col("event_type") == PURCHASE).filter(~F.col("is_large")).select("event_id", "is_large")


@query(f"{CLICKS} SELECT {_SHOWN} FROM clicks WHERE country = 'US' AND event_type = 'purchase'")
def flt_08_sequence(spark, sf):
    frame = clicks(spark, sf).filter(F.col("country") == "US").filter(F.col("event_type") == PURCHASE)
    return frame.select(*_COLUMNS)


@query(
    f"{CLICKS} SELECT {_SHOWN} FROM clicks WHERE event_type = 'purchase' AND total_amount >= 50 AND day_of_week IN (1, 7)"
)
def flt_09_filter_list(spark, sf):
    tests = [
        F.col("event_type") == PURCHASE,
        F.col("total_amount") >= 50,
        F.col("day_of_week").isin(1, 7),
    ]
    return rel.where_all(clicks(spark, sf), tests).select(*_COLUMNS)


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def flt_10_after(spark, sf):
    return rel.after(read_table(spark, sf, "events"), "ts", "2024-01-15T00:00:00").select("event_id", "ts")


# --- NULL handling --------------------------------------------------------------


@query(f"{CLICKS} SELECT event_id, coalesce(price, 0.0) AS price, coalesce(category, 'Unknown') AS category FROM clicks")
def nul_01_fill(spark, sf):
    filled = rel.fill_nulls(clicks(spark, sf), {"price": 0.0, "category": "Unknown"})
    return filled.select("event_id", "price", "category")


@query(f"{CLICKS} SELECT event_id, product_id, category FROM clicks WHERE product_id IS NOT NULL AND category IS NOT NULL")
def nul_02_drop(spark, sf):
    kept = rel.drop_nulls(clicks(spark, sf), ["product_id", "category"])
    return kept.select("event_id", "product_id", "category")


@query(f"{CLICKS} SELECT event_id, category, coalesce(category, 'Unknown') AS category_or_default FROM clicks")
def nul_03_first_known(spark, sf):
    return clicks(spark, sf).select(
        "event_id", "category", F.coalesce("category", F.lit("Unknown")).alias("category_or_default")
    )


# --- scalar functions -----------------------------------------------------------


@query(f"{RECORDS} SELECT event_id, CASE WHEN NOT bad_user THEN cast(user_id AS int) END AS user_id FROM records")
def scl_01_int(spark, sf):
    return _raw(spark, sf).select(F.col("event_id").cast("long").alias("event_id"), int_or_null("user_id").alias("user_id"))


@query(f"{RECORDS} SELECT event_id, price, quantity, total_amount FROM records")
def scl_02_numbers(spark, sf):
    return _raw(spark, sf).select(
        F.col("event_id").cast("long").alias("event_id"),
        double_or_null("price").alias("price"),
        int_or_null("quantity").alias("quantity"),
        double_or_null("total_amount").alias("total_amount"),
    )


@query(f"{RECORDS} SELECT event_id, CASE WHEN NOT bad_time THEN event_timestamp END AS event_timestamp FROM records")
def scl_03_timestamp(spark, sf):
    return _raw(spark, sf).select(
        F.col("event_id").cast("long").alias("event_id"),
        timestamp_or_null("timestamp").alias("event_timestamp"),
    )


@query("SELECT event_id, cast(ts AS date) AS event_date FROM events")
def scl_04_date(spark, sf):
    return read_table(spark, sf, "events").select("event_id", F.to_date("ts").alias("event_date"))


@query("SELECT event_id, cast(extract(hour FROM ts) AS int) AS event_hour FROM events")
def scl_05_hour(spark, sf):
    return read_table(spark, sf, "events").select("event_id", F.hour("ts").alias("event_hour"))


@query("SELECT event_id, cast(extract(dow FROM ts) + 1 AS int) AS day_of_week FROM events")
def scl_06_day_of_week(spark, sf):
    return read_table(spark, sf, "events").select("event_id", F.dayofweek("ts").alias("day_of_week"))


@query(
    "WITH p AS (SELECT event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) "
    "SELECT event_id, cast(floor(epoch(ts)) - floor(epoch(before)) AS bigint) AS seconds_since_prev FROM p"
)
def scl_07_seconds_between(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    pairs = neighbours(events, ["user_id"], ["ts", "event_id"], before={"before": "ts"})
    return pairs.select("event_id", (epoch_seconds("ts") - epoch_seconds("before")).alias("seconds_since_prev"))


@query(f"{RECORDS} SELECT event_id, device, country, event_type FROM records")
def scl_08_case_and_trim(spark, sf):
    return _raw(spark, sf).select(
        F.col("event_id").cast("long").alias("event_id"),
        normal_text("device").alias("device"),
        normal_text("country", "upper").alias("country"),
        normal_text("event_type").alias("event_type"),
    )


@query(f"SELECT conv_id, turn, len({WORDS.format('text')}) AS words FROM conversations")
def scl_09_split(spark, sf):
    talk = read_table(spark, sf, "conversations")
    return talk.select("conv_id", "turn", F.size(words("text")).cast("long").alias("words"))


@query(f"SELECT conv_id, turn, unnest({WORDS.format('text')}) AS word FROM conversations")
def scl_10_explode(spark, sf):
    talk = read_table(spark, sf, "conversations")
    return talk.select("conv_id", "turn", F.explode(words("text")).alias("word"))


@query(
    f"{CLICKS} SELECT event_id, CASE WHEN event_hour < 6 THEN 'night' WHEN event_hour < 12 THEN 'morning' "
    "WHEN event_hour < 18 THEN 'afternoon' ELSE 'evening' END AS hour_bucket FROM clicks"
)
def scl_11_case(spark, sf):
    return clicks(spark, sf).select("event_id", hour_bucket("event_hour").alias("hour_bucket"))


@query("SELECT event_id, 'events_table' AS source, true AS loaded, 1 AS one FROM events")
def scl_12_literals(spark, sf):
    return read_table(spark, sf, "events").select(
        "event_id", F.lit("events_table").alias("source"), F.lit(True).alias("loaded"), F.lit(1).alias("one")
    )


@query(f"SELECT l_orderkey, l_linenumber, {rounded('l_extendedprice * (1 - l_discount)')} AS net_price FROM lineitem")
def scl_13_round(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", round2(net).alias("net_price"))


@query(
    "SELECT l_orderkey, l_linenumber, l_discount / nullif(l_tax, 0) AS discount_per_tax, "
    "l_discount / nullif(l_tax, 0) * 100 AS discount_pct FROM lineitem"
)
def scl_14_ratio(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.try_divide("l_discount", "l_tax").alias("discount_per_tax"),
        percent("l_discount", "l_tax").alias("discount_pct"),
    )


@query(
    "SELECT l_orderkey, l_linenumber, l_extendedprice - l_quantity AS difference, "
    "l_extendedprice * l_quantity AS product, l_extendedprice / l_quantity AS unit_price FROM lineitem"
)
def scl_15_arithmetic(spark, sf):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (price - quantity).alias("difference"),
        (price * quantity).alias("product"),
        (price / quantity).alias("unit_price"),
    )


@query("SELECT event_id, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM events")
def scl_16_json_fields(spark, sf):
    events = read_table(spark, sf, "events")
    return events.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@query(f"{RECORDS} SELECT event_id, coalesce(category, 'Unknown') AS category FROM records")
def scl_17_field_default(spark, sf):
    return _raw(spark, sf).select(
        F.col("event_id").cast("long").alias("event_id"),
        F.coalesce("category", F.lit("Unknown")).alias("category"),
    )


@query(f"{RECORDS} SELECT event_id, total_amount FROM records WHERE total_amount IS NOT NULL AND total_amount <> 0")
def scl_18_nonzero(spark, sf):
    amounts = _raw(spark, sf).select(
        F.col("event_id").cast("long").alias("event_id"), double_or_null("total_amount").alias("total_amount")
    )
    return amounts.filter(F.col("total_amount").isNotNull() & (F.col("total_amount") != 0))


@query(f"SELECT event_id, '{RUN_TIME}' AS processed_at FROM events")
def scl_19_run_time(spark, sf):
    return read_table(spark, sf, "events").select("event_id", F.lit(RUN_TIME).alias("processed_at"))


# --- distinct and union ---------------------------------------------------------


@query(f"{CLICKS} SELECT DISTINCT device, country FROM clicks")
def set_01_distinct(spark, sf):
    return clicks(spark, sf).select("device", "country").distinct()


@query(
    f"{CLICKS} SELECT session_id, event_id, event_timestamp, event_type FROM (SELECT *, row_number() OVER "
    "(PARTITION BY session_id ORDER BY event_timestamp, event_id) AS rn FROM clicks) WHERE rn = 1"
)
def set_02_first_per_key(spark, sf):
    frame = clicks(spark, sf).select("session_id", "event_id", "event_timestamp", "event_type")
    return rel.first_per_key(frame, ["session_id"], ["event_timestamp", "event_id"])


@query(
    f"{CLICKS} SELECT event_id, device FROM clicks WHERE device = 'mobile' "
    "UNION ALL SELECT event_id, device FROM clicks WHERE device = 'desktop'"
)
def set_03_union(spark, sf):
    frame = clicks(spark, sf).select("event_id", "device")
    return rel.stacked(frame.filter(F.col("device") == "mobile"), frame.filter(F.col("device") == "desktop"))


@query(f"{CLICKS} SELECT count(*) - count(DISTINCT session_id) AS duplicates FROM clicks")
def set_04_duplicates(spark, sf):
    return rel.duplicate_count(clicks(spark, sf), ["session_id"])


# --- sort and limit -------------------------------------------------------------


@query("SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id")
def srt_01_ascending(spark, sf):
    return read_table(spark, sf, "events").select("event_id", "ts", "event_type").orderBy("ts", "event_id")


@query("SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id")
def srt_02_descending(spark, sf):
    return read_table(spark, sf, "events").select("event_id", "ts", "event_type").orderBy(F.desc("ts"), "event_id")


@query("SELECT user_id, ts, event_type, event_id FROM events ORDER BY user_id, ts DESC, event_id")
def srt_03_mixed(spark, sf):
    frame = read_table(spark, sf, "events").select("user_id", "ts", "event_type", "event_id")
    return frame.orderBy(F.asc("user_id"), F.desc("ts"), F.asc("event_id"))


@query("SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 1500")
def srt_04_limit(spark, sf):
    return rel.top_k(read_table(spark, sf, "events").select("event_id", "event_type", "value"), 1500, F.asc("event_id"))


@query(
    f"{CLICKS} SELECT product_id, count(*) AS n FROM clicks WHERE product_id IS NOT NULL "
    "GROUP BY product_id ORDER BY n DESC, product_id LIMIT 10"
)
def srt_05_top_k(spark, sf):
    counts = (
        clicks(spark, sf)
        .filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return rel.top_k(counts, 10, F.desc("n"), F.asc("product_id"))


@query("SELECT min(cast(ts AS date)) AS sample_date FROM events")
def srt_06_sample_value(spark, sf):
    return rel.sample_value(clicks(spark, sf), "event_date", "sample_date")
