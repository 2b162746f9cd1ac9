"""Sources, sinks and layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.money import money_sum
from tidemark.operators.relational import stacked
from tidemark.queries.registry import CATEGORY_DIM, CLICKS, RECORDS, money, query
from tidemark.sources import layout, readers, sinks
from tidemark.sources.clicks import category_dimension, clicks, paid_purchases, raw_records
from tidemark.sources.schemas import DEVICES, RAW_EVENT
from tidemark.sources.scratch import fresh_dir

DAY = dt.date(2024, 1, 15)

# Columns that make the round trips, and their types in text files.
TRIP = ["event_id", "event_type", "device", "country", "event_date", "total_amount"]
TRIP_SCHEMA = "event_id long, event_type string, device string, country string, event_date date, total_amount double"

BY_TYPE = f"SELECT event_type, count(*) AS n, {money('total_amount')} AS revenue FROM clicks GROUP BY event_type"


def _trip(spark, sf):
    return clicks(spark, sf).select(*TRIP)


def _by_type(df):
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), money_sum("total_amount").alias("revenue"))


# --- sources --------------------------------------------------------------------

_DEVICE_ROWS = ", ".join(f"('{d}', {i})" for i, d in enumerate(DEVICES))


@query(
    f"{CLICKS}, names(device, device_no) AS (VALUES {_DEVICE_ROWS}) "
    "SELECT device, cast(device_no AS bigint) AS device_no, count(*) AS n FROM clicks JOIN names USING (device) GROUP BY device, device_no"
)
def src_01_local_rows(spark, sf):
    rows = [{"device": d, "device_no": i} for i, d in enumerate(DEVICES)]
    names = readers.local_rows(spark, rows)
    counts = clicks(spark, sf).groupBy("device").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(names), "device")


@query(
    f"{CLICKS}, names(event_type, is_paid) AS (VALUES ('view', false), ('click', false), ('purchase', true)) "
    "SELECT event_type, is_paid, count(*) AS n FROM clicks JOIN names USING (event_type) GROUP BY event_type, is_paid"
)
def src_02_local_rows_with_schema(spark, sf):
    rows = [("view", False), ("click", False), ("purchase", True)]
    names = readers.local_table(spark, rows, "event_type string, is_paid boolean")
    counts = clicks(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(names), "event_type")


@query(
    f"{CLICKS}, {CATEGORY_DIM}, sales AS (SELECT category, {money('total_amount')} AS revenue FROM clicks "
    "WHERE event_type = 'purchase' GROUP BY category) "
    "SELECT category, revenue, department, tax_rate, revenue * tax_rate AS tax FROM sales JOIN dim USING (category)"
)
def src_03_local_dimension(spark, sf):
    sales = paid_purchases(clicks(spark, sf)).groupBy("category").agg(money_sum("total_amount").alias("revenue"))
    joined = sales.join(F.broadcast(category_dimension(spark)), "category")
    return joined.withColumn("tax", F.col("revenue") * F.col("tax_rate"))


@query(
    f"{RECORDS} SELECT cast(event_id AS varchar) AS event_id, CASE WHEN bad_user THEN 'invalid' ELSE cast(user_id AS varchar) END AS user_id, "
    "category, price, quantity, total_amount FROM records"
)
def src_04_json_strings(spark, sf):
    parsed = readers.parse_json(raw_records(clicks(spark, sf)), RAW_EVENT)
    known = parsed.filter(F.col("event_id").isNotNull())
    return known.select("event_id", "user_id", "category", "price", "quantity", "total_amount")


@query(f"{CLICKS} {BY_TYPE}")
def src_05_json_files(spark, sf):
    path = sinks.write_json(_trip(spark, sf), fresh_dir(spark, "json"))
    return _by_type(readers.read_json(spark, path, TRIP_SCHEMA))


@query(f"{CLICKS} {BY_TYPE}")
def src_06_csv_files(spark, sf):
    path = sinks.write_csv(_trip(spark, sf), fresh_dir(spark, "csv"))
    return _by_type(readers.read_csv(spark, path, TRIP_SCHEMA))


@query("SELECT l_returnflag, count(*) AS n, max(l_quantity) AS max_quantity FROM lineitem GROUP BY l_returnflag")
def src_07_parquet(spark, sf):
    lines = readers.read_table(spark, sf, "lineitem")
    return lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("max_quantity"))


@query(
    f"{CLICKS} SELECT event_type, count(*) AS n FROM clicks WHERE event_date = DATE '{DAY}' AND country = 'US' GROUP BY event_type"
)
def src_08_partitioned(spark, sf):
    path = sinks.write_partitioned(_trip(spark, sf), fresh_dir(spark, "by-date-country"), ["event_date", "country"])
    one = readers.pruned_scan(readers.read_required(spark, path), event_date=DAY, country="US")
    return one.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"{CLICKS} SELECT country, count(*) AS n FROM clicks GROUP BY country")
def src_09_view(spark, sf):
    readers.as_view(clicks(spark, sf), "clicks")
    return spark.table("clicks").groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query(f"{CLICKS} SELECT event_type, count(*) AS event_count FROM clicks GROUP BY event_type ORDER BY event_count DESC")
def src_10_sql(spark, sf):
    return readers.query_view(
        clicks(spark, sf),
        "SELECT event_type, count(*) AS event_count FROM {source} GROUP BY event_type ORDER BY event_count DESC",
    )


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def src_12_required_input(spark, sf):
    orders = readers.read_required(spark, f"{sf}/orders.parquet", "the table generator")
    return orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


# --- sinks ----------------------------------------------------------------------


@query(f"{CLICKS} {BY_TYPE}")
def snk_01_parquet(spark, sf):
    return _by_type(readers.read_required(spark, sinks.write_parquet(_trip(spark, sf), fresh_dir(spark, "parquet"))))


@query(f"{CLICKS} SELECT device, count(*) AS n FROM clicks GROUP BY device")
def snk_02_csv(spark, sf):
    path = sinks.write_csv(_trip(spark, sf), fresh_dir(spark, "csv"))
    return readers.read_csv(spark, path, TRIP_SCHEMA).groupBy("device").agg(F.count(F.lit(1)).alias("n"))


@query(f"{CLICKS} SELECT device, count(*) AS n FROM clicks GROUP BY device")
def snk_03_json(spark, sf):
    path = sinks.write_json(_trip(spark, sf), fresh_dir(spark, "json"))
    return readers.read_json(spark, path, TRIP_SCHEMA).groupBy("device").agg(F.count(F.lit(1)).alias("n"))


@query(f"{CLICKS} SELECT event_date, count(*) AS n FROM clicks GROUP BY event_date")
def snk_04_by_date(spark, sf):
    path = sinks.write_partitioned(_trip(spark, sf), fresh_dir(spark, "by-date"), ["event_date"])
    return readers.read_required(spark, path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


@query(f"{CLICKS} SELECT event_date, country, count(*) AS n FROM clicks GROUP BY event_date, country")
def snk_05_by_date_and_country(spark, sf):
    path = sinks.write_partitioned(_trip(spark, sf), fresh_dir(spark, "by-date-country"), ["event_date", "country"])
    return readers.read_required(spark, path).groupBy("event_date", "country").agg(F.count(F.lit(1)).alias("n"))


@query(f"{CLICKS} SELECT event_date, count(*) AS n, count(DISTINCT event_id) AS events, true AS within_bound FROM clicks GROUP BY event_date")
def snk_05_guarded(spark, sf):
    # A folder for each event would be too many; the layout falls back to dates.
    path = fresh_dir(spark, "guarded")
    layout.write_guarded(_trip(spark, sf), path, ["event_date", "event_id"])
    within = layout.files(spark, path).select("folder").distinct().count() <= layout.PARTITIONS
    return readers.read_required(spark, path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("events"), F.lit(within).alias("within_bound")
    )


@query(f"{CLICKS} SELECT count(*) AS n_rows, true AS within_bound FROM clicks")
def snk_06_few_files(spark, sf):
    rows = _trip(spark, sf)
    path = sinks.write_parquet(sinks.with_few_files(rows), fresh_dir(spark, "few-files"))
    per_file = readers.read_required(spark, path).groupBy(F.col("_metadata.file_path").alias("file")).count()
    within = F.count(F.lit(1)) <= sinks.file_count(rows, 4)
    return per_file.agg(F.sum("count").alias("n_rows"), within.alias("within_bound"))


@query(f"{CLICKS} {BY_TYPE}")
def snk_07_codec(spark, sf):
    path = sinks.write_parquet(_trip(spark, sf), fresh_dir(spark, "snappy"), codec="snappy")
    return _by_type(readers.read_required(spark, path))


@query(
    f"{CLICKS} SELECT format, count(*) AS n, count(total_amount) AS amounts FROM clicks, "
    "(VALUES ('parquet'), ('csv'), ('json')) formats(format) GROUP BY format"
)
def snk_08_round_trips(spark, sf):
    trip = _trip(spark, sf)
    back = {
        "parquet": readers.read_required(spark, sinks.write_parquet(trip, fresh_dir(spark, "trip"))),
        "csv": readers.read_csv(spark, sinks.write_csv(trip, fresh_dir(spark, "trip")), TRIP_SCHEMA),
        "json": readers.read_json(spark, sinks.write_json(trip, fresh_dir(spark, "trip")), TRIP_SCHEMA),
    }
    return stacked(
        *(
            df.agg(F.count(F.lit(1)).alias("n"), F.count("total_amount").alias("amounts")).select(
                F.lit(name).alias("format"), "n", "amounts"
            )
            for name, df in back.items()
        )
    )


# --- layouts --------------------------------------------------------------------


@query(
    f"""{CLICKS} SELECT 'none' AS layout, count(*) AS n FROM clicks WHERE event_date = DATE '{DAY}'
  UNION ALL SELECT 'date', count(*) FROM clicks WHERE event_date = DATE '{DAY}'
  UNION ALL SELECT 'date_country', count(*) FROM clicks WHERE event_date = DATE '{DAY}' AND country = 'US'"""
)
def lay_01_layouts(spark, sf):
    trip = _trip(spark, sf)
    none = sinks.write_parquet(sinks.with_few_files(trip), fresh_dir(spark, "layout-none"))
    date = sinks.write_partitioned(trip, fresh_dir(spark, "layout-date"), ["event_date"])
    both = sinks.write_partitioned(trip, fresh_dir(spark, "layout-both"), ["event_date", "country"])
    scans = {
        "none": readers.pruned_scan(readers.read_required(spark, none), event_date=DAY),
        "date": readers.pruned_scan(readers.read_required(spark, date), event_date=DAY),
        "date_country": readers.pruned_scan(readers.read_required(spark, both), event_date=DAY, country="US"),
    }
    return stacked(
        *(
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layout"), "n")
            for name, df in scans.items()
        )
    )


@query(f"{CLICKS} SELECT event_date, count(*) AS n, {money('total_amount')} AS revenue, true AS full_files FROM clicks GROUP BY event_date")
def lay_01_packed(spark, sf):
    # Every task writes to every folder; then the files of a folder are packed.
    loose, to = fresh_dir(spark, "loose"), fresh_dir(spark, "packed")
    _trip(spark, sf).repartition(8).write.partitionBy("event_date").parquet(loose)
    path = layout.packed(readers.read_required(spark, loose), loose, to, ["event_date"])
    # No folder could do with two files less.
    needed = F.ceil(F.sum("bytes") / sinks.FILE_BYTES) + 1
    full = layout.files(spark, path).groupBy("folder").agg((F.count(F.lit(1)) <= needed).alias("full"))
    full_files = full.agg(F.bool_and("full")).first()[0]
    return readers.read_required(spark, path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), money_sum("total_amount").alias("revenue"), F.lit(full_files).alias("full_files")
    )


@query(f"{CLICKS} SELECT category, {money('total_amount')} AS revenue FROM clicks WHERE event_type = 'purchase' GROUP BY category")
def lay_02_pruned_columns(spark, sf):
    narrow = clicks(spark, sf).select("event_type", "category", "total_amount")
    return narrow.filter(F.col("event_type") == "purchase").groupBy("category").agg(
        money_sum("total_amount").alias("revenue")
    )


@query(
    f"{CLICKS} SELECT category, {money('total_amount')} AS revenue FROM clicks "
    "WHERE event_type = 'purchase' AND country = 'US' GROUP BY category"
)
def lay_03_filtered_aggregate(spark, sf):
    chosen = (F.col("event_type") == "purchase") & (F.col("country") == "US")
    frame = clicks(spark, sf).select("event_type", "category", "total_amount", "country")
    return frame.filter(chosen).groupBy("category").agg(money_sum("total_amount").alias("revenue"))
