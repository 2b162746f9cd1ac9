"""Aggregates, and aggregates over a shared input."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tidemark.functions.buckets import hour_bucket
from tidemark.functions.money import money_avg, money_sum, money_sum_or_zero, percent, ratio, round2
from tidemark.operators import distinct
from tidemark.operators.aggregates import by_each, count_where, first_in_group, listed
from tidemark.operators.caching import cached
from tidemark.operators.layers import daily_metrics
from tidemark.operators.relational import stacked
from tidemark.queries.registry import CLICKS, money, query, rounded
from tidemark.sources.clicks import PURCHASE, clicks, purchases, with_hour_buckets
from tidemark.sources.readers import read_table
from tidemark.sources.scratch import frozen



_AMOUNT_IF_PAID = "CASE WHEN event_type = 'purchase' THEN total_amount ELSE 0 END"


def _paid():
    return F.col("event_type") == PURCHASE


def _rows():
    return F.count(F.lit(1))


@query(
    f"""{CLICKS} SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT session_id) AS unique_sessions, {money('total_amount')} AS total_revenue,
  {money('total_amount')} / count(total_amount) AS avg_order_value, max(total_amount) AS max_order_value FROM clicks"""
)
def agg_01_global(spark, sf):
    measures = {
        "total_events": _rows(),
        "total_revenue": money_sum("total_amount"),
        "avg_order_value": money_avg("total_amount"),
        "max_order_value": F.max("total_amount"),
    }
    apart = {"unique_users": F.col("user_id"), "unique_sessions": F.col("session_id")}
    return distinct.measured(clicks(spark, sf), [], measures, apart)


@query(f"{CLICKS} SELECT event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users FROM clicks GROUP BY event_type")
def agg_02_one_key(spark, sf):
    return clicks(spark, sf).groupBy("event_type").agg(
        _rows().alias("event_count"), F.count_distinct("user_id").alias("unique_users")
    )


@query(
    f"""{CLICKS} SELECT device, country, count(*) AS num_purchases, {money('total_amount')} AS total_revenue,
  {rounded(money('total_amount') + ' / count(total_amount)')} AS avg_order_value, count(DISTINCT user_id) AS unique_buyers
  FROM clicks WHERE event_type = 'purchase' GROUP BY device, country"""
)
def agg_03_two_keys(spark, sf):
    return (
        purchases(clicks(spark, sf))
        .groupBy("device", "country")
        .agg(
            _rows().alias("num_purchases"),
            money_sum("total_amount").alias("total_revenue"),
            round2(money_avg("total_amount")).alias("avg_order_value"),
            F.count_distinct("user_id").alias("unique_buyers"),
        )
    )


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus")
def agg_04_count(spark, sf):
    return read_table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(_rows().alias("n"))


@query(
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers "
    "FROM lineitem GROUP BY l_returnflag"
)
def agg_05_distinct(spark, sf):
    return read_table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag")
def agg_05_bitmaps(spark, sf):
    """Bitmaps per flag, status and month of shipping, merged to flags without a second look at the rows."""
    lines = read_table(spark, sf, "lineitem").withColumn("month", F.date_trunc("month", "l_shipdate"))
    fine = distinct.id_bitmaps(lines, ["l_returnflag", "l_linestatus", "month"], "l_partkey")
    return distinct.distinct_from(fine, ["l_returnflag"], "parts")


@query(f"{CLICKS} SELECT event_type, {money('total_amount')} AS revenue FROM clicks GROUP BY event_type")
def agg_06_sum(spark, sf):
    return clicks(spark, sf).groupBy("event_type").agg(money_sum("total_amount").alias("revenue"))


@query(f"SELECT p_type, {money('p_retailprice')} / count(p_retailprice) AS avg_price FROM part GROUP BY p_type")
def agg_07_average(spark, sf):
    return read_table(spark, sf, "part").groupBy("p_type").agg(money_avg("p_retailprice").alias("avg_price"))


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY user_id")
def agg_08_min_max(spark, sf):
    return read_table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )


@query(
    f"{CLICKS} SELECT user_id, device AS primary_device FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id ORDER BY event_timestamp, event_id) AS rn FROM clicks) WHERE rn = 1"
)
def agg_09_first(spark, sf):
    first = first_in_group("device", "event_timestamp", "event_id")
    return clicks(spark, sf).groupBy("user_id").agg(first.alias("primary_device"))


@query(
    """WITH n AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
  SELECT user_id, (rn - 1) // 10000 AS part, count(*) AS events_in_part,
  string_agg(event_type, ',' ORDER BY rn) AS events_list FROM n GROUP BY user_id, (rn - 1) // 10000"""
)
def agg_10_collect(spark, sf):
    events = read_table(spark, sf, "events")
    lists = listed(events, ["user_id"], "event_type", ["ts", "event_id"], name="events_list", list_rows=10_000)
    return lists.select(
        "user_id",
        "part",
        F.size("events_list").cast("long").alias("events_in_part"),
        F.array_join("events_list", ",").alias("events_list"),
    )


@query(f"{CLICKS} SELECT device, count(*) FILTER (WHERE event_type = 'purchase') AS num_purchases FROM clicks GROUP BY device")
def agg_11_count_if(spark, sf):
    return clicks(spark, sf).groupBy("device").agg(count_where(_paid()).alias("num_purchases"))


@query(
    f"{CLICKS} SELECT country, {money(_AMOUNT_IF_PAID)} AS revenue FROM clicks GROUP BY country"
)
def agg_12_sum_if(spark, sf):
    return clicks(spark, sf).groupBy("country").agg(money_sum_or_zero("total_amount", _paid()).alias("revenue"))


@query(
    f"""{CLICKS}, d AS (SELECT event_date, count(DISTINCT user_id) AS u, count(*) FILTER (WHERE event_type = 'purchase') AS p,
  {money('total_amount')} AS r FROM clicks GROUP BY event_date)
  SELECT event_date, {rounded('cast(p AS double) / u * 100')} AS conversion_rate, {rounded('r / nullif(p, 0)')} AS avg_order_value FROM d"""
)
def agg_13_derived(spark, sf):
    per_day = clicks(spark, sf).groupBy("event_date").agg(
        F.count_distinct("user_id").alias("u"),
        count_where(_paid()).alias("p"),
        money_sum("total_amount").alias("r"),
    )
    return per_day.select(
        "event_date",
        round2(percent("p", "u")).alias("conversion_rate"),
        round2(ratio("r", "p")).alias("avg_order_value"),
    )


@query(
    """SELECT l_shipdate, cast(round(sum(cast(l_extendedprice AS decimal(18,6)) * (1 - cast(l_discount AS decimal(10,6)))), 2) AS double) AS revenue
  FROM lineitem GROUP BY l_shipdate"""
)
def agg_14_rounded(spark, sf):
    """The sum is exact and rounded once; the lines are not rounded."""
    net = F.col("l_extendedprice").cast("decimal(18,4)") * (1 - F.col("l_discount").cast("decimal(8,4)"))
    revenue = F.round(F.try_sum(net.cast("decimal(38,8)")), 2).cast("double")
    return read_table(spark, sf, "lineitem").groupBy("l_shipdate").agg(revenue.alias("revenue"))


@query(
    f"{CLICKS} SELECT {money('total_amount')} AS total_revenue, count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases FROM clicks"
)
def agg_15_aggregate_of_aggregate(spark, sf):
    return daily_metrics(clicks(spark, sf)).agg(
        money_sum("daily_revenue").alias("total_revenue"), F.sum("num_purchases").alias("total_purchases")
    )


_BUCKET = "CASE WHEN event_hour < 6 THEN 'night' WHEN event_hour < 12 THEN 'morning' WHEN event_hour < 18 THEN 'afternoon' ELSE 'evening' END"


@query(f"{CLICKS} SELECT {_BUCKET} AS hour_bucket, {money('price')} / count(price) AS avg_price FROM clicks GROUP BY {_BUCKET}")
def agg_16_bucket(spark, sf):
    return (
        clicks(spark, sf)
        .groupBy(hour_bucket("event_hour").alias("hour_bucket"))
        .agg(money_avg("price").alias("avg_price"))
    )


# --- shared input ---------------------------------------------------------------

_SHARED = f"{CLICKS}, shared AS (SELECT *, {_BUCKET} AS hour_bucket FROM clicks WHERE event_type IN ('view','click','purchase'))"


@query(
    f"""{_SHARED} SELECT 'category' AS dimension, category AS value, cast(count(*) AS double) AS measure FROM shared GROUP BY category
  UNION ALL SELECT 'device', device, cast(count(*) FILTER (WHERE event_type = 'purchase') AS double) FROM shared GROUP BY device
  UNION ALL SELECT 'hour_bucket', hour_bucket, {money('price')} / count(price) FROM shared GROUP BY hour_bucket"""
)
def cch_01_cache(spark, sf):
    # What is kept is aggregated to all three dimensions, a few hundred rows.
    shared = (
        with_hour_buckets(clicks(spark, sf))
        .groupBy("category", "device", "hour_bucket")
        .agg(
            _rows().alias("n"),
            F.sum("is_purchase").alias("bought"),
            money_sum("price").alias("price_sum"),
            F.count("price").alias("prices"),
        )
    )
    questions = {
        "category": F.sum("n").cast("double"),
        "device": F.sum("bought").cast("double"),
        "hour_bucket": ratio(money_sum("price_sum"), F.sum("prices")),
    }
    with cached(shared) as kept:
        answers = [
            frozen(
                kept.groupBy(F.col(d).alias("value"))
                .agg(m.alias("measure"))
                .select(F.lit(d).alias("dimension"), "value", "measure"),
                f"shared-{d}",
            )
            for d, m in questions.items()
        ]
    return stacked(*answers)


@query(f"{CLICKS} SELECT category, device, count(*) AS n FROM clicks WHERE event_type IN ('view','click','purchase') GROUP BY category, device")
def cch_02_persist(spark, sf):
    """The small aggregate is persisted, and two actions read it: desktops, and all other devices."""
    counted = with_hour_buckets(clicks(spark, sf)).groupBy("category", "device").agg(_rows().alias("n"))
    desktop = F.col("device").eqNullSafe("desktop")
    with cached(counted, StorageLevel.MEMORY_AND_DISK) as kept:
        return stacked(*(frozen(kept.filter(part), "persisted") for part in (desktop, ~desktop)))


@query(
    "\nUNION ALL ".join(
        [
            f"({_SHARED} SELECT '{d}' AS dimension, {d} AS value, count(*) AS n, "
            f"count(*) FILTER (WHERE event_type = 'purchase') AS purchases, {money('price')} / count(price) AS avg_price "
            f"FROM shared GROUP BY {d})"
            for d in ("category", "device", "hour_bucket")
        ]
    )
)
def cch_03_three_aggregates(spark, sf):
    return by_each(
        with_hour_buckets(clicks(spark, sf)),
        ["category", "device", "hour_bucket"],
        {"n": _rows(), "purchases": F.sum("is_purchase"), "avg_price": money_avg("price")},
    )
