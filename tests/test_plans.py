"""What the plans read, push down, broadcast and shuffle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import difference, spark_rows
from tidemark.functions.udfs import price_tier_by_row
from tidemark.operators import joins, quality
from tidemark.operators.windows import top_per_group
from tidemark.plans.inspect import count_nodes, optimized_plan, partition_count, physical_plan
from tidemark.plans.sizing import (
    UNKNOWN,
    broadcast_if_few,
    broadcast_if_small,
    estimated_bytes,
    fits_one_task,
)
from tidemark.queries import QUERIES
from tidemark.sources import readers, sinks
from tidemark.sources.clicks import category_dimension, clicks, purchases, raw_records
from tidemark.sources.readers import read_table
from tidemark.sources.schemas import RAW_EVENT
from tidemark.sources.scratch import fresh_dir

DAY = dt.date(2024, 1, 10)


def test_filter_and_columns_reach_the_scan(spark, folder):
    plan = physical_plan(QUERIES["flt_01_equals"](spark, folder).select("event_id"))
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_moment_reaches_the_scan(spark, folder):
    assert "GreaterThan(ts,2024-01-15T00:00)" in physical_plan(QUERIES["flt_10_after"](spark, folder))


def test_partition_filters(spark, folder):
    path = sinks.write_partitioned(
        clicks(spark, folder).select("event_id", "event_date", "country"), fresh_dir(spark, "t"), ["event_date", "country"]
    )
    scan = readers.pruned_scan(readers.read_required(spark, path), event_date=DAY, country="US")
    plan = physical_plan(scan)
    assert "PartitionFilters: [isnotnull(event_date" in plan and "(country#" in plan
    assert "PushedFilters: []" in plan


def test_small_dimension_is_broadcast(spark, folder):
    sales = purchases(clicks(spark, folder))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plan = physical_plan(joins.JOINS[how](sales, category_dimension(spark), "category"))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def sizes_are(monkeypatch, small_facts, small_lookup):
    """Make the joins take the sides for small or large, whatever their size. Lookups have a column ``d``."""
    small = lambda df, *limit: small_lookup if "d" in df.columns else small_facts
    monkeypatch.setattr(joins, "may_broadcast", small)
    monkeypatch.setattr(joins, "fits_one_task", small)
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df: F.broadcast(df) if small(df) else df)


def skewed(spark):
    """Facts of which a third have key 7, some no key and some an unknown one; lookup rows without facts, two for key 7."""
    ids = spark.range(0, 6000, 1, 16)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 1000)
    facts = ids.select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    lookup = spark.range(900).select((F.col("id") + 150).alias("k"), F.lit("x").alias("d"))
    more = spark.createDataFrame([(7, "hot"), (7, "hot too"), (None, "none")], "k long, d string")
    return facts, lookup.unionByName(more)


CASES = [(False, True), (False, False), (True, True), (True, False)]


@pytest.mark.parametrize("small_facts,small_lookup", CASES)
@pytest.mark.parametrize("how", ["right", "full"])
def test_right_and_full_by_size(spark, monkeypatch, how, small_facts, small_lookup):
    facts, lookup = skewed(spark)
    want = spark_rows(facts.join(lookup, "k", how))
    sizes_are(monkeypatch, small_facts, small_lookup)
    got = joins.JOINS[how](facts, lookup, "k")
    plan = optimized_plan(got)
    assert difference(spark_rows(got), want) is None
    outer = {"right": "RightOuter", "full": "FullOuter"}[how]
    if small_facts:
        assert outer in plan and ("strategy=broadcast" in plan) == (how == "right")
    elif small_lookup:
        assert outer not in plan and "strategy=broadcast" in plan
    else:
        assert outer in plan and "LeftAnti" not in plan  # no key is hot: Spark's own join


@pytest.mark.parametrize("known", [True, False])
@pytest.mark.parametrize("how", ["right", "full"])
def test_hot_facts_of_a_right_or_full_join_are_dealt(spark, monkeypatch, how, known):
    facts, lookup = skewed(spark)
    for side in (lookup, lookup.filter("k <> 7")):
        want = spark_rows(facts.join(side, "k", how))
        sizes_are(monkeypatch, False, False)
        hot = joins.hot_keys(facts, "k", 500)
        assert [r.asDict() for r in hot.collect()] == [{"k": 7, "_n": 2004}]
        if known:
            monkeypatch.setattr(joins, "hot_keys", None)  # not counted again
        got = joins.JOINS[how](facts, side, "k", hot=hot if known else None, rows=500)
        assert difference(spark_rows(got), want) is None
        monkeypatch.undo()
        if side is lookup:
            plan = optimized_plan(got)
            assert "_salts" in plan and "LeftAnti" in plan
            assert got.filter("k = 7").select("d").distinct().count() == 2


@pytest.mark.parametrize("how", ["right", "full"])
def test_hot_facts_are_joined_by_many_tasks(spark, small_skew, monkeypatch, how):
    facts, lookup = skewed(spark)
    sizes_are(monkeypatch, False, False)
    monkeypatch.setattr(joins, "broadcast_if_few", lambda df, n: df)
    got = joins.JOINS[how](facts, lookup, "k", rows=200)
    tasks = got.filter("k = 7").groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(tasks) > 3 and max(t["n"] for t in tasks) < 4008 / 3


def test_large_lookup_is_not_broadcast(spark, folder):
    table = read_table(spark, folder, "part")
    assert "strategy=broadcast" in optimized_plan(table.join(broadcast_if_small(table.select("p_partkey")), "p_partkey"))
    unmarked = broadcast_if_small(table.select("p_partkey"), limit=0)
    assert "strategy=broadcast" not in optimized_plan(table.join(unmarked, "p_partkey"))
    assert "strategy=broadcast" not in optimized_plan(table.join(broadcast_if_few(table.select("p_partkey"), 10, 9), "p_partkey"))


def test_late_and_early_filter_have_one_plan(spark, folder):
    tests = [F.col("country") == "US", F.col("event_type") == "purchase"]
    frame, dim = clicks(spark, folder), category_dimension(spark)

    def plan(df):
        import re

        return re.sub(r"#\d+L?", "", optimized_plan(df))

    assert plan(joins.late_filter(frame, dim, "category", tests)) == plan(joins.early_filter(frame, dim, "category", tests))


def test_top_per_group_limits_before_the_shuffle(spark, folder):
    plan = physical_plan(top_per_group(read_table(spark, folder, "events"), ["user_id"], "value", "event_id", 3))
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning") > plan.index("Final")


def test_json_is_parsed_once(spark, folder):
    lines = raw_records(clicks(spark, folder))
    parsed = readers.parse_json(lines, RAW_EVENT).filter("event_id IS NOT NULL AND price > 3")
    assert optimized_plan(parsed).count("from_json(") == 1
    for name in ("med_05_split", "med_07_daily_metrics", "rdd_11_revenue_from_json"):
        frame = QUERIES[name](spark, folder)
        scans = optimized_plan(frame).count("Relation [")
        assert optimized_plan(frame).count("from_json(") == scans, name


@pytest.mark.parametrize("name", ["udf_01_built_in", "rdd_10_word_count", "med_07_daily_metrics", "win_01_row_number"])
def test_built_ins_stay_in_the_jvm(spark, folder, name):
    plan = physical_plan(QUERIES[name](spark, folder))
    assert "EvalPython" not in plan and "InPandas" not in plan


def test_python_udf_is_evaluated_when_its_column_is_used(spark, folder):
    frame = clicks(spark, folder).withColumn("tier", price_tier_by_row()("total_amount"))
    assert "EvalPython" in physical_plan(frame.groupBy("tier").count())
    assert "EvalPython" not in optimized_plan(frame.groupBy().count())


def test_daily_windows_run_on_the_daily_table(spark, folder):
    plan = physical_plan(QUERIES["win_10_running_total"](spark, folder))
    assert plan.index("SinglePartition") < plan.index("HashAggregate(keys=[event_date")


def test_three_aggregates_from_one_scan(spark, folder):
    assert count_nodes(QUERIES["cch_03_three_aggregates"](spark, folder), "FileScan") == 1


def test_metric_set_is_one_scan(spark, folder):
    bought = F.col("event_type") == "purchase"
    row = quality.metric_row(
        clicks(spark, folder),
        {
            "n": quality.Metric(F.count),
            "spent": quality.Metric(F.sum, "total_amount", [bought]),
            "dirty": quality.Metric(F.sum, "device", [bought], kind="double"),
            "absent": quality.Metric(F.sum, "no_such_column"),
        },
    )
    assert count_nodes(row, "FileScan") == 1


def test_distinct_counts_do_not_multiply_the_rows(spark, folder):
    for name in ("agg_01_global", "agg_05_bitmaps"):
        plan = optimized_plan(QUERIES[name](spark, folder))
        assert "Expand" not in plan, name


@pytest.mark.parametrize(
    "name", [n for n in sorted(QUERIES) if n.startswith(("jn_", "agg_", "med_0", "med_1", "prd_", "win_", "set_"))]
)
def test_no_cross_join(spark, folder, name):
    plan = physical_plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_sizes(spark, folder):
    events = read_table(spark, folder, "events")
    assert 0 < estimated_bytes(events.select("user_id")) < estimated_bytes(events) < UNKNOWN
    assert fits_one_task(events) and not fits_one_task(events, limit=10)


def test_files_grow_with_the_table(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    size = estimated_bytes(lines)
    assert sinks.file_count(lines, 4) == 4
    assert sinks.file_count(lines, 4, file_bytes=size // 10) in (10, 11)
    assert partition_count(sinks.with_few_files(lines.repartition(16))) == 4


@pytest.fixture
def small_skew(spark):
    """Shuffled joins, with a skew limit that a test table can pass."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", sorted(set(joins.JOINS) - {"right", "full"}))
def test_hot_key_of_a_shuffled_join_is_split(spark, small_skew, monkeypatch, how):
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df: df)
    ids = spark.range(0, 60000, 1, 16)
    facts = ids.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    lookup = spark.range(900).select((F.col("id") + 50).alias("k"), F.lit("x").alias("d"))
    lookup = lookup.unionByName(spark.range(1).select(F.lit(7).cast("long").alias("k"), F.lit("hot").alias("d")))
    got = joins.JOINS[how](facts, lookup, "k")
    n = got.count()
    got.collect()
    assert "skew=true" in physical_plan(got)
    assert n == facts.join(lookup, "k", how).count()


def test_large_partitioned_write_splits_a_hot_folder(spark, folder, monkeypatch):
    monkeypatch.setattr(sinks, "fits_one_task", lambda df: False)
    rows = spark.range(0, 90000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        path = sinks.write_partitioned(rows, fresh_dir(spark, "hot"), ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(path)
    files = written.groupBy("day").agg(F.count_distinct("_metadata.file_path").alias("n"), F.count(F.lit(1)).alias("rows"))
    per_day = {r["day"]: (r["n"], r["rows"]) for r in files.collect()}
    assert per_day["hot"][0] > 2 and per_day["hot"][1] == 30000
    assert sum(rows for _, rows in per_day.values()) == 90000
