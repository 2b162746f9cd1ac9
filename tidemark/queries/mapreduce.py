"""Key/value forms and UDFs."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.functions.buckets import price_tier
from tidemark.functions.text import words
from tidemark.functions.udfs import discounted, price_tier_by_row
from tidemark.operators import keyvalue as kv
from tidemark.operators import records
from tidemark.operators.relational import stacked, top_k
from tidemark.plans.inspect import partition_count
from tidemark.queries.registry import CLICKS, RECORDS, WORDS, money, query
from tidemark.sources.clicks import PURCHASE, clicks, paid_purchases, raw_records
from tidemark.sources.readers import local_table, read_table
from tidemark.sources.schemas import DEVICES


@query(f"{CLICKS} SELECT event_id, user_id, event_type, event_timestamp FROM clicks")
def rdd_01_rows_and_back(spark, sf):
    return kv.rows_and_back(clicks(spark, sf).select("event_id", "user_id", "event_type", "event_timestamp"))


@query(f"{CLICKS} SELECT device, count(*) AS n FROM clicks WHERE device IN ('mobile', 'desktop', 'tablet') GROUP BY device")
def rdd_02_local_list(spark, sf):
    names = local_table(spark, [(d,) for d in DEVICES], ["device"])
    counts = clicks(spark, sf).groupBy("device").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(names), "device", "left_semi")


@query("SELECT event_id, user_id * 2 AS doubled FROM events")
def rdd_03_map(spark, sf):
    return kv.map_rows(read_table(spark, sf, "events"), event_id=F.col("event_id"), doubled=F.col("user_id") * 2)


@query(f"SELECT unnest({WORDS.format('text')}) AS word FROM conversations")
def rdd_04_flat_map(spark, sf):
    return kv.flat_map(read_table(spark, sf, "conversations"), words("text"), "word")


@query("SELECT event_id, event_type FROM events WHERE event_type = 'purchase'")
def rdd_05_filter(spark, sf):
    return read_table(spark, sf, "events").filter(F.col("event_type") == PURCHASE).select("event_id", "event_type")


@query(f"{CLICKS} SELECT DISTINCT device FROM clicks")
def rdd_06_distinct(spark, sf):
    return clicks(spark, sf).select("device").distinct()


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def rdd_07_reduce_by_key(spark, sf):
    return kv.reduce_by_key(read_table(spark, sf, "lineitem"), "l_suppkey", F.lit(1), "n")


_COUNT = f"SELECT word, count(*) AS n FROM (SELECT unnest({WORDS.format('text')}) AS word FROM documents) GROUP BY word"


@query(f"{_COUNT} ORDER BY n DESC, word")
def rdd_08_sort_by(spark, sf):
    return kv.word_count(read_table(spark, sf, "documents")).orderBy(F.desc("n"), F.asc("word"))


@query(_COUNT)
def rdd_09_word_count_rdd(spark, sf):
    return kv.word_count_rdd(read_table(spark, sf, "documents"))


@query(_COUNT)
def rdd_10_word_count(spark, sf):
    return kv.word_count(read_table(spark, sf, "documents"))


@query(
    f"{RECORDS} SELECT coalesce(category, 'Unknown') AS category, {money('total_amount')} AS revenue FROM records "
    "WHERE event_type = 'purchase' AND total_amount <> 0 GROUP BY 1"
)
def rdd_11_revenue_from_json(spark, sf):
    return kv.revenue_by_category(raw_records(clicks(spark, sf)))


@query(
    f"{CLICKS} SELECT form, device, count(*) AS n FROM clicks, (VALUES ('table'), ('rdd')) forms(form) "
    "WHERE event_type = 'purchase' GROUP BY form, device"
)
def rdd_12_both_forms(spark, sf):
    frame = clicks(spark, sf)
    return stacked(
        kv.purchases_per_device(frame).withColumn("form", F.lit("table")),
        kv.purchases_per_device_rdd(frame).withColumn("form", F.lit("rdd")),
    )


@query(
    f"{CLICKS} SELECT 'first' AS action, event_id FROM (SELECT event_id FROM clicks ORDER BY event_id LIMIT 1) "
    "UNION ALL SELECT 'take', event_id FROM (SELECT event_id FROM clicks ORDER BY event_id LIMIT 5) "
    "UNION ALL SELECT 'count', count(*) FROM clicks"
)
def rdd_13_actions(spark, sf):
    ids = clicks(spark, sf).select("event_id")
    return stacked(
        top_k(ids, 1, F.asc("event_id")).select(F.lit("first").alias("action"), "event_id"),
        top_k(ids, 5, F.asc("event_id")).select(F.lit("take").alias("action"), "event_id"),
        ids.agg(F.count(F.lit(1)).alias("event_id")).select(F.lit("count").alias("action"), "event_id"),
    )


@query("SELECT count(*) AS n_rows, true AS within_partitions FROM lineitem")
def rdd_14_partitions(spark, sf):
    """Rows counted by partition add up, and stand in no more partitions than the frame has."""
    frame = read_table(spark, sf, "lineitem")
    per_partition = frame.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    within = (F.count(F.lit(1)) <= partition_count(frame)) & (F.max("partition") < partition_count(frame))
    return per_partition.agg(F.sum("n").alias("n_rows"), within.alias("within_partitions"))


# --- UDFs -----------------------------------------------------------------------

_TIER = "CASE WHEN total_amount >= 200 THEN 'high' WHEN total_amount >= 50 THEN 'medium' ELSE 'low' END"


@query(f"{CLICKS} SELECT {_TIER} AS price_tier, count(*) AS n FROM clicks GROUP BY 1")
def udf_01_built_in(spark, sf):
    return clicks(spark, sf).groupBy(price_tier("total_amount").alias("price_tier")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"{CLICKS} SELECT CASE WHEN total_amount IS NULL THEN 'unknown' ELSE {_TIER} END AS price_tier, count(*) AS n FROM clicks GROUP BY 1"
)
def udf_02_by_row(spark, sf):
    tier = price_tier_by_row()
    tiers = clicks(spark, sf).select(tier("total_amount").alias("price_tier"))
    return tiers.groupBy("price_tier").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"{CLICKS} SELECT event_id, total_amount * cast(0.9 AS double) AS discounted_amount FROM clicks "
    "WHERE event_type = 'purchase' AND total_amount IS NOT NULL"
)
def udf_03_vectorised(spark, sf):
    keep = discounted()
    return paid_purchases(clicks(spark, sf)).select("event_id", keep("total_amount").alias("discounted_amount"))


@query(f"{RECORDS} SELECT category, count(*) AS n FROM records WHERE category IS NOT NULL GROUP BY category")
def udf_04_parse_and_extract(spark, sf):
    lines = raw_records(clicks(spark, sf))
    category = F.from_json("value", "category string").getField("category")
    found = lines.select(category.alias("category")).filter(F.col("category").isNotNull())
    return found.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"{RECORDS} SELECT category, CAST(NULL AS VARCHAR) AS error, count(*) AS n FROM records WHERE category IS NOT NULL GROUP BY category "
    "UNION ALL SELECT NULL, 'JSONDecodeError', count(*) FROM clicks WHERE event_id % 97 = 0"
)
def udf_04_own_function(spark, sf):
    """The same categories by a Python function over the raw lines, and how many lines it could not read."""

    def category(line):
        found = json.loads(line).get("category")
        return None if found is None else {"category": found}

    found = records.mapped_records(raw_records(clicks(spark, sf)), "value", category, "category string")
    return found.groupBy("category", F.col(records.ERROR).alias("error")).agg(F.count(F.lit(1)).alias("n"))
