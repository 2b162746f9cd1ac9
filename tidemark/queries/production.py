"""Incremental processing, data quality, versioned dimensions, metric sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.money import amount, money_sum
from tidemark.operators import history, quality
from tidemark.operators.increments import IncrementalTable, VersionedTable
from tidemark.operators.relational import duplicate_count, stacked
from tidemark.queries.registry import CLICKS, ORACLE, money, query, rounded
from tidemark.sources.clicks import PURCHASE, clicks
from tidemark.sources.readers import read_table
from tidemark.sources.scratch import fresh_dir

MARK = "2024-01-15T00:00:00"
CRITICAL = ["event_id", "user_id", "event_timestamp", "event_type"]
# Columns with NULLs, and one the table does not have.
CHECKED = [*CRITICAL, "product_id", "total_amount", "coupon"]


@query(
    f"""SELECT count(*) AS total_records, count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-15 00:00:00') AS incremental_records,
    {rounded("cast(count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-15 00:00:00') AS double) / count(*) * 100", 1)} AS incremental_ratio,
    max(ts) AS next_mark FROM events"""
)
def prd_01_incremental(spark, sf):
    """The mark is stored after the rows up to MARK, and once more after none; the report starts from the stored one."""
    events, path = read_table(spark, sf, "events"), fresh_dir(spark, "mark")
    history.save_mark(events.filter(F.col("ts") <= F.lit(MARK).cast("timestamp_ntz")), "ts", path)
    history.save_mark(events.filter(F.col("ts").isNull()), "ts", path)
    return history.increment_report(events, "ts", history.read_mark(spark, path) or MARK)


@query("SELECT event_id, ts, user_id, event_type FROM events")
def prd_01_committed(spark, sf):
    """The events as a source that grows over time, taken in increments; rows and mark are published together."""
    events = read_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    table = IncrementalTable(spark, fresh_dir(spark, "increments"), events.schema, "ts", every=2)
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    for part in (1, 2) if first is not None else ():
        moment = F.lit(first + (last - first) * part / 3).cast("timestamp_ntz")
        table.process(events.filter((F.col("ts") <= moment) | F.col("ts").isNull()))
    table.process(events)
    return table.read()


@query(
    f"{CLICKS} SELECT "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in CHECKED if c != "coupon")
    + " FROM clicks"
)
def prd_02_null_counts(spark, sf):
    return quality.null_counts(clicks(spark, sf), CHECKED)


def _report_sql(columns: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS n FROM clicks"
        for c in columns
    )
    return (
        f"{CLICKS}, counted AS ({rows}), report AS (SELECT \"column\", nulls, cast(nulls AS double) / nullif(n, 0) * 100 AS null_pct, "
        "CASE WHEN n = 0 THEN 'EMPTY' WHEN cast(nulls AS double) / n * 100 < 1 THEN 'OK' ELSE 'REVIEW' END AS status FROM counted)"
    )


@query(
    _report_sql(CHECKED[:-1])
    + " SELECT count(*) AS columns_checked, count(*) FILTER (WHERE status = 'REVIEW') AS columns_failed, "
    "CASE WHEN count(*) FILTER (WHERE status = 'EMPTY') > 0 THEN 'EMPTY' WHEN count(*) FILTER (WHERE status = 'REVIEW') = 0 "
    "THEN 'PASSED' ELSE 'NEEDS REVIEW' END AS verdict FROM report"
)
def prd_03_null_gate(spark, sf):
    return quality.null_gate(clicks(spark, sf), CHECKED)


@query(_report_sql(CHECKED[:-1]) + " SELECT * FROM report UNION ALL SELECT 'coupon', NULL, NULL, 'MISSING'")
def prd_04_column_guard(spark, sf):
    return quality.null_report(clicks(spark, sf), CHECKED)


@query(
    f"{CLICKS} SELECT 'event_id' AS key, count(*) - count(DISTINCT event_id) AS duplicates FROM clicks "
    "UNION ALL SELECT 'session_id', count(*) - count(DISTINCT session_id) FROM clicks"
)
def prd_05_duplicates(spark, sf):
    frame = clicks(spark, sf)
    return stacked(
        *(duplicate_count(frame, [k]).select(F.lit(k).alias("key"), "duplicates") for k in ("event_id", "session_id"))
    )


_VERSIONS = """versions AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate AS valid_from,
    lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next FROM orders)"""


def _versions(spark, sf):
    orders = read_table(spark, sf, "orders")
    return history.versions(orders, "o_custkey", "o_orderdate", "o_orderkey", ["o_orderpriority"])


@query(
    f"WITH {_VERSIONS} SELECT o_custkey, o_orderkey, o_orderpriority, valid_from, "
    "coalesce(next, TIMESTAMP '9999-12-31 00:00:00') AS valid_to, next IS NULL AS is_current FROM versions"
)
def prd_06_versions(spark, sf):
    return _versions(spark, sf)


@query(ORACLE["prd_06_versions"])
def prd_06_merged(spark, sf):
    """The same history, merged from three increments that arrive out of order."""
    orders, at = read_table(spark, sf, "orders"), F.col("o_orderdate")
    table = VersionedTable(
        spark, fresh_dir(spark, "versions"), orders.schema, "o_custkey", "o_orderdate", "o_orderkey", ["o_orderpriority"]
    )
    late, early = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1994-01-01"))
    table.merge(orders.filter((at >= late) | at.isNull()))
    table.merge(orders.filter(at < early))
    table.merge(orders.filter((at >= early) & (at < late)))
    return table.read()


@query(
    f"""WITH {_VERSIONS}, facts AS (SELECT o_custkey, l_shipdate, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT v.o_orderpriority AS priority_then, count(*) AS n, {money('l_quantity')} AS quantity FROM facts f LEFT JOIN versions v
    ON f.o_custkey = v.o_custkey AND v.valid_from <= f.l_shipdate AND f.l_shipdate < coalesce(v.next, TIMESTAMP '9999-12-31 00:00:00')
  GROUP BY v.o_orderpriority"""
)
def prd_07_point_in_time(spark, sf):
    orders = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    shipped = lines.join(orders, "l_orderkey")
    then = history.as_of(
        shipped, _versions(spark, sf), "o_custkey", "l_shipdate", ["o_orderpriority"], tie=["l_orderkey", "l_linenumber"], disjoint=True
    )
    return then.groupBy(F.col("o_orderpriority").alias("priority_then")).agg(
        F.count(F.lit(1)).alias("n"), money_sum("l_quantity").alias("quantity")
    )


@query(
    f"""{CLICKS} SELECT cast(count(*) AS double) AS total_events, cast(count(DISTINCT user_id) AS double) AS unique_users,
    cast(count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS double) AS buyers,
    {money("CASE WHEN event_type = 'purchase' THEN total_amount END")} AS total_revenue,
    max(total_amount) FILTER (WHERE event_type = 'purchase' AND country = 'US') AS largest_us_order,
    cast(0 AS double) AS revenue_of_views, cast(NULL AS double) AS bad_metric FROM clicks"""
)
def prd_08_metric_set(spark, sf):
    bought = F.col("event_type") == PURCHASE
    metric = quality.Metric
    return quality.metric_set(
        clicks(spark, sf).withColumn("amount", amount("total_amount")),
        {
            "total_events": metric(F.count),
            "unique_users": metric(F.count_distinct, "user_id"),
            "buyers": metric(F.count_distinct, "user_id", [bought]),
            "total_revenue": metric(F.sum, "amount", [bought]),
            "largest_us_order": metric(F.max, "total_amount", [bought, F.col("country") == "US"]),
            "revenue_of_views": metric(F.sum, "amount", [F.col("event_type") == "view"]),
            "bad_metric": metric(F.sum, "no_such_column"),
        },
    )
