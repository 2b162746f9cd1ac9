"""Edge rows of the layers, the buckets and the quality checks."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.buckets import hour_bucket, price_tier, user_segment
from tidemark.functions.udfs import tier_of
from tidemark.operators import keyvalue, layers, quality
from tidemark.sources.clicks import clicks, purchases, raw_records
from tidemark.sources.readers import MissingInput
from tidemark.sources.scratch import fresh_dir

NOW = "2024-02-01T00:00:00"


def event(**changes):
    base = {
        "event_id": "e1", "timestamp": "2024-01-01T10:20:30", "user_id": 7, "event_type": "purchase",
        "device": "mobile", "country": "US", "session_id": "s", "product_id": "p", "category": "Books",
        "price": 10.0, "quantity": 2, "total_amount": 20.0, "search_query": None,
    }
    return json.dumps({**base, **changes})


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def one(spark, text):
    clean = layers.cleaned(layers.bronze(lines(spark, text), NOW), NOW)
    return clean.first()


@pytest.mark.parametrize(
    "text",
    [
        '{"event_id": "e1"', "", "  ", "plain words", "null", "[1, 2]", "17", '"text"', '[{"event_id": "e1"}]',
        '{"event_id": "e1"} rest', '{"event_id": "e1"}{"event_id": "e2"}', '{"event_id": "e1"},{"event_id": "e2"}',
        '{"event_id": "e1",}', "{'event_id': 'e1'}", "]", '{"event_id": "e1"}]',
        '{"event_id": "e1"}] {"event_id": "e2"}', '{"event_id": "e1"},{"event_id": "e2"}]',
    ],
)
def test_text_that_is_no_object_is_a_parse_error(spark, text):
    row = layers.bronze(lines(spark, text), NOW).first()
    assert (row["_bronze_status"], row["_bronze_error"]) == ("parse_error", "MALFORMED_JSON")
    assert row["_bronze_raw_data"] == text and row["event_id"] is None
    assert one(spark, text) is None


def test_good_record(spark):
    row = one(spark, event())
    assert row["_silver_is_valid"] and row["_bronze_error"] is None and row["_bronze_status"] == "valid"
    assert (row["user_id_clean"], row["event_hour"], row["day_of_week"]) == (7, 10, 2)  # a Monday
    assert row["_silver_processed_time"] == NOW and row["_bronze_ingestion_time"] == NOW


@pytest.mark.parametrize(
    "changes",
    [{"user_id": "invalid"}, {"user_id": "1.5"}, {"user_id": None}, {"timestamp": "not-a-date"},
     {"timestamp": None}, {"event_type": None}, {"user_id": "99999999999"}],
)
def test_bad_field_means_quarantine(spark, changes):
    table = layers.cleaned(layers.bronze(lines(spark, event(**changes), event()), NOW), NOW)
    assert layers.silver(table).count() == 1
    bad = layers.quarantine(table)
    assert bad.count() == 1 and bad.first()["_bronze_raw_data"] == event(**changes)


def test_text_is_normalised(spark):
    row = one(spark, event(device=" Mobile ", country=" us", event_type="PURCHASE ", user_id=" 12 "))
    assert (row["device"], row["country"], row["event_type"], row["user_id_clean"]) == ("mobile", "US", "purchase", 12)


def test_word_in_a_number_field_spoils_that_field_only(spark):
    row = one(spark, event(price="cheap", total_amount="7.5"))
    assert row["price"] is None and row["total_amount"] == 7.5 and row["_silver_is_valid"]


def test_no_record_is_lost(spark, folder):
    raw = raw_records(clicks(spark, folder))
    bronze = layers.bronze(raw, NOW)
    clean = layers.cleaned(bronze, NOW)
    errors = bronze.filter("_bronze_status = 'parse_error'").count()
    assert raw.count() == layers.silver(clean).count() + layers.quarantine(clean).count() + errors
    assert errors > 0 and layers.quarantine(clean).count() > 0
    assert layers.silver(clean).columns == layers.SILVER_COLUMNS


def test_stored_layers(spark, folder):
    at = layers.Layers(fresh_dir(spark, "layers"))
    raw = raw_records(clicks(spark, folder))
    seen = layers.write_bronze(raw, at, NOW)
    counts = layers.write_silver(spark, at, NOW)
    assert seen["bronze_records"] == sum(counts.values()) + seen["parse_errors"]
    layers.write_gold(spark, at)
    row = layers.layer_summary(spark, at).first()
    assert row["silver_records"] == counts["silver_records"]
    silver = spark.read.parquet(at.silver)
    assert row["total_purchases"] == purchases(silver).count()
    by_category = spark.read.parquet(at.gold("category_metrics")).agg(F.sum("num_purchases")).first()[0]
    assert by_category == row["total_purchases"]


def test_later_step_needs_the_earlier_one(spark):
    at = layers.Layers(fresh_dir(spark, "layers"))
    with pytest.raises(MissingInput, match="write_bronze"):
        layers.write_silver(spark, at, NOW)
    with pytest.raises(MissingInput, match="write_silver"):
        layers.write_gold(spark, at)


def test_a_day_without_purchase(spark):
    table = layers.silver(layers.cleaned(layers.bronze(lines(spark, event(event_type="page_view")), NOW), NOW))
    row = layers.daily_metrics(table).first()
    assert row["conversion_rate"] == 0 and row["avg_order_value"] is None and row["daily_revenue"] == 0


def test_zero_and_null_amounts(spark):
    raw = lines(
        spark, event(), event(total_amount=0), event(total_amount=None), event(category=None, total_amount=3),
        event(event_type="view"), "{broken",
    )
    got = {r["category"]: r["revenue"] for r in keyvalue.revenue_by_category(raw).collect()}
    assert got == {"Books": 20.0, "Unknown": 3.0}
    clean = layers.silver(layers.cleaned(layers.bronze(raw, NOW), NOW))
    books = [r for r in layers.category_metrics(clean).collect() if r["category"] == "Books"]
    assert (books[0]["num_purchases"], books[0]["total_events"]) == (3, 4)


def column(spark, values, make, kind="double"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(make("v")).collect()]


def test_bounds_of_classes(spark):
    assert column(spark, [200.0, 199.99, 50.0, 49.99, None], price_tier) == ["high", "medium", "medium", "low", "low"]
    assert [tier_of(v) for v in (200.0, 199.99, 50.0, 49.99, None)] == ["high", "medium", "medium", "low", "unknown"]
    assert column(spark, [500.0, 500.01, 100.0, 100.01, 0.0, 0.01], user_segment) == [
        "Medium Value", "High Value", "Low Value", "Medium Value", "Non-Purchaser", "Low Value",
    ]
    assert column(spark, [0, 5, 6, 11, 12, 17, 18, 23], hour_bucket, "int") == [
        "night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening",
    ]


def test_null_share_at_the_limit(spark):
    frame = spark.range(100).select(F.when(F.col("id") > 0, F.col("id")).alias("a"), F.lit(1).alias("b"))
    rows = {r["column"]: (r["nulls"], r["null_pct"], r["status"]) for r in quality.null_report(frame, ["a", "b", "c"]).collect()}
    assert rows == {"a": (1, 1.0, "REVIEW"), "b": (0, 0.0, "OK"), "c": (None, None, "MISSING")}
    assert quality.null_gate(frame, ["a", "b", "c"]).first()["verdict"] == "NEEDS REVIEW"
    assert quality.null_gate(frame, ["b"]).first()["verdict"] == "PASSED"


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a int")
    row = quality.null_report(empty, ["a"]).first()
    assert (row["nulls"], row["null_pct"], row["status"]) == (0, None, "EMPTY")
    assert quality.null_gate(empty, ["a"]).first()["verdict"] == "EMPTY"


def test_metric_that_cannot_be_computed(spark):
    frame = spark.createDataFrame([(1, 2.0), (2, None)], "id int, x double")
    metrics = {
        "n": quality.Metric(F.count),
        "none": quality.Metric(F.sum, "x", [F.col("id") == 2]),
        "no_column": quality.Metric(F.sum, "y"),
        "no_filter_column": quality.Metric(F.sum, "x", [F.col("z") == 2]),
    }
    assert quality.metric_set(frame, metrics).first().asDict() == {
        "n": 2.0, "none": 0.0, "no_column": None, "no_filter_column": None,
    }
