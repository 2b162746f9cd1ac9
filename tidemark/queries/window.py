"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.casts import epoch_seconds
from tidemark.functions.money import amount, round2
from tidemark.operators import windows as win
from tidemark.queries.registry import CLICKS, money, query, rounded
from tidemark.sources.clicks import PURCHASE, clicks, paid_purchases

PAID = f"{CLICKS}, paid AS (SELECT * FROM clicks WHERE event_type = 'purchase' AND total_amount IS NOT NULL)"
BY_AMOUNT = "PARTITION BY user_id ORDER BY total_amount DESC"
BY_TIME = "PARTITION BY user_id ORDER BY event_timestamp, event_id"


def _paid(spark, sf):
    frame = paid_purchases(clicks(spark, sf))
    return frame.select("user_id", "event_id", "total_amount", "category")


def _ranked(spark, sf):
    return win.ranked(_paid(spark, sf), ["user_id"], "total_amount", "event_id")


@query(f"{PAID} SELECT user_id, event_id, total_amount, category, row_number() OVER ({BY_AMOUNT}, event_id) AS row_num FROM paid")
def win_01_row_number(spark, sf):
    return _ranked(spark, sf).select("user_id", "event_id", "total_amount", "category", "row_num")


@query(f"{PAID} SELECT user_id, event_id, total_amount, rank() OVER ({BY_AMOUNT}) AS rank FROM paid")
def win_02_rank(spark, sf):
    return _ranked(spark, sf).select("user_id", "event_id", "total_amount", "rank")


@query(f"{PAID} SELECT user_id, event_id, total_amount, dense_rank() OVER ({BY_AMOUNT}) AS dense_rank FROM paid")
def win_03_dense_rank(spark, sf):
    return _ranked(spark, sf).select("user_id", "event_id", "total_amount", "dense_rank")


@query(f"{PAID} SELECT user_id, event_id, total_amount, cast(ntile(4) OVER ({BY_AMOUNT}, event_id) AS int) AS quartile FROM paid")
def win_04_ntile(spark, sf):
    return _ranked(spark, sf).select("user_id", "event_id", "total_amount", "quartile")


@query(
    f"{PAID} SELECT * FROM (SELECT user_id, event_id, total_amount, category, "
    f"row_number() OVER ({BY_AMOUNT}, event_id) AS row_num FROM paid) WHERE row_num <= 3"
)
def win_05_top_per_group(spark, sf):
    return win.top_per_group(_paid(spark, sf), ["user_id"], "total_amount", "event_id", 3)


def _activity(spark, sf, before=None, after=None):
    frame = clicks(spark, sf).select("user_id", "event_id", "event_timestamp", "event_type")
    return win.neighbours(frame, ["user_id"], ["event_timestamp", "event_id"], before, after)


@query(f"{CLICKS} SELECT event_id, event_type, lag(event_type) OVER ({BY_TIME}) AS prev_event FROM clicks")
def win_06_lag(spark, sf):
    return _activity(spark, sf, before={"prev_event": "event_type"}).select("event_id", "event_type", "prev_event")


@query(
    f"""{CLICKS}, p AS (SELECT event_id, event_timestamp, lag(event_timestamp) OVER ({BY_TIME}) AS prev_timestamp FROM clicks)
  SELECT event_id, prev_timestamp, cast(floor(epoch(event_timestamp)) - floor(epoch(prev_timestamp)) AS bigint) AS seconds_since_prev FROM p"""
)
def win_07_lag_time(spark, sf):
    pairs = _activity(spark, sf, before={"prev_timestamp": "event_timestamp"})
    gap = epoch_seconds("event_timestamp") - epoch_seconds("prev_timestamp")
    return pairs.select("event_id", "prev_timestamp", gap.alias("seconds_since_prev"))


@query(f"{CLICKS} SELECT event_id, event_type, lead(event_type) OVER ({BY_TIME}) AS next_event FROM clicks")
def win_08_lead(spark, sf):
    return _activity(spark, sf, after={"next_event": "event_type"}).select("event_id", "event_type", "next_event")


@query(
    f"{CLICKS}, p AS (SELECT event_type, lag(event_type) OVER ({BY_TIME}) AS prev_event FROM clicks) "
    "SELECT prev_event, count(*) AS num_purchases FROM p WHERE event_type = 'purchase' GROUP BY prev_event"
)
def win_09_transitions(spark, sf):
    pairs = _activity(spark, sf, before={"prev_event": "event_type"})
    bought = pairs.filter(F.col("event_type") == PURCHASE)
    return (
        bought.groupBy("prev_event")
        .agg(F.count(F.lit(1)).alias("num_purchases"))
        .orderBy(F.desc("num_purchases"), F.asc("prev_event"))
    )


DAILY = (
    f"{PAID}, daily AS (SELECT event_date, {money('total_amount')} AS daily_revenue, count(*) AS num_orders FROM paid GROUP BY event_date)"
)


def _daily(spark, sf):
    return win.daily_sales(paid_purchases(clicks(spark, sf)), "event_date", "total_amount")


@query(
    f"{DAILY} SELECT event_date, daily_revenue, num_orders, "
    "cast(sum(cast(daily_revenue AS decimal(38,9))) OVER (ORDER BY event_date) AS double) AS cumulative_revenue FROM daily"
)
def win_10_running_total(spark, sf):
    return win.running_total(_daily(spark, sf), "event_date", "daily_revenue", "cumulative_revenue")


_SEVEN = "OVER (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_MEAN = f"cast(sum(cast(daily_revenue AS decimal(38,9))) {_SEVEN} AS double) / count(*) {_SEVEN}"


@query(f"{DAILY} SELECT event_date, daily_revenue, num_orders, {rounded(_MEAN)} AS rolling_7day_avg_revenue FROM daily")
def win_11_moving_average(spark, sf):
    return win.moving_average(_daily(spark, sf), "event_date", "daily_revenue", "rolling_7day_avg_revenue")


_BEFORE = "lag(daily_revenue) OVER (ORDER BY event_date)"


@query(
    f"{DAILY} SELECT event_date, daily_revenue, num_orders, "
    f"{rounded(f'(daily_revenue - {_BEFORE}) / nullif({_BEFORE}, 0) * 100')} AS day_over_day_change FROM daily"
)
def win_12_day_over_day(spark, sf):
    return win.change_from_previous(_daily(spark, sf), "event_date", "daily_revenue", "day_over_day_change")


def _lifetime(spark, sf):
    paid = paid_purchases(clicks(spark, sf)).select(
        "user_id", "event_id", "event_timestamp", amount("total_amount").alias("amount")
    )
    return win.running(
        paid, ["user_id"], "event_timestamp", "event_id", "amount",
        total="lifetime_value", rows_so_far="total_purchases", average="avg_order_value",
    )


_LTV = "OVER (PARTITION BY user_id ORDER BY event_timestamp)"
_LTV_SUM = f"cast(sum(cast(total_amount AS decimal(38,9))) {_LTV} AS double)"


@query(f"{PAID} SELECT user_id, event_id, event_timestamp, {_LTV_SUM} AS lifetime_value FROM paid")
def win_13_lifetime_value(spark, sf):
    return _lifetime(spark, sf).select("user_id", "event_id", "event_timestamp", "lifetime_value")


@query(f"{PAID} SELECT user_id, event_id, event_timestamp, count(*) {_LTV} AS total_purchases FROM paid")
def win_14_running_count(spark, sf):
    return _lifetime(spark, sf).select("user_id", "event_id", "event_timestamp", "total_purchases")


@query(
    f"{PAID} SELECT user_id, event_id, event_timestamp, {rounded(f'{_LTV_SUM} / count(total_amount) {_LTV}')} AS avg_order_value FROM paid"
)
def win_15_running_average(spark, sf):
    return _lifetime(spark, sf).select(
        "user_id", "event_id", "event_timestamp", round2("avg_order_value").alias("avg_order_value")
    )
