"""Dirty amounts, failing metrics, missing shared folders, and plans chosen by size."""

import glob
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.money import money_avg, money_sum, money_sum_or_zero
from tidemark.operators import joins, layers, quality
from tidemark.operators import windows as win
from tidemark.operators.aggregates import listed_long
from tidemark.operators.blocks import Limits
from tidemark.plans.inspect import physical_plan
from tidemark.plans.sizing import broadcast_if_few
from tidemark.sources import scratch
from tidemark.sources.readers import with_json_object
from tidemark.sources.scratch import fresh_dir


def test_amounts_below_a_cent_and_beyond_any_sum(spark):
    amounts = spark.createDataFrame([(0.004,)] * 3, "x double")
    assert amounts.agg(money_sum("x"), money_avg("x"), money_sum_or_zero("x", F.lit(True))).first() == (0.012, 0.004, 0.012)
    wild = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (1e40,), (None,)], "x double")
    assert wild.agg(money_sum("x"), money_avg("x")).first() == (1.5, 1.5)


def test_dirty_amounts_go_to_quarantine(spark):
    def line(i, amount):
        return (
            f'{{"event_id": "{i}", "timestamp": "2024-01-0{i}T10:00:00", "user_id": "{i}", "event_type": "purchase", '
            f'"product_id": "p", "category": "Books", "price": "1", "quantity": "1", "total_amount": {amount}}}'
        )

    lines = spark.createDataFrame([(line(1, "12.5"),), (line(2, "1e17"),), (line(3, '"NaN"'),), (line(4, "0.004"),), ("junk",)], "value string")
    with scratch.removed_after(spark):
        at = layers.build_layers(lines, scratch.fresh_dir(spark, "dirty"), "2024-01-31T00:00:00")
        assert spark.read.parquet(at.silver).count() == 2
        assert spark.read.parquet(at.quarantine).count() == 2
        assert spark.read.parquet(at.gold("daily_metrics")).agg(F.sum("daily_revenue")).first()[0] == 12.504


def test_json_lines_that_go_on_are_not_records(spark):
    lines = spark.createDataFrame(
        [('{"event_id": "1"}',), ('{"event_id":"1"}, {"_mark": "end"}]',), ('{"event_id":"1"} x',), (None,)], "value string"
    )
    got = [r.e for r in with_json_object(lines, "value", ["event_id"], "e").collect()]
    assert [e is not None for e in got] == [True, False, False, False]


def test_a_failing_metric_leaves_the_others(spark):
    df = spark.createDataFrame([("1", 2.0), ("x", 3.0)], "B string, v double")
    metric = quality.Metric
    got = quality.metric_set(
        df,
        {
            "total": metric(F.sum, "v"),
            "dirty": metric(lambda c: F.sum(c.cast("int")), "B"),
            "absent": metric(F.sum, "nope"),
            "other_case": metric(F.count, "b"),
            "nothing": metric(F.sum, "v", [F.col("v") > 9]),
        },
    )
    assert got.first().asDict() == {"total": 5.0, "dirty": None, "absent": None, "other_case": 2.0, "nothing": 0.0}
    assert dict(got.dtypes) == dict.fromkeys(got.columns, "double")


def test_a_bad_cast_spoils_its_own_metric_in_one_scan(spark, monkeypatch):
    df = spark.createDataFrame([("1", 2.0, "a"), ("x", 3.0, "b"), (None, 4.0, "a")], "B string, v double, g string")
    metric = quality.Metric
    runs = []
    computed = quality._computed
    monkeypatch.setattr(quality, "_computed", lambda row: runs.append(row) or computed(row))
    got = quality.metric_set(
        df,
        {
            "total": metric(F.sum, "v"),
            "clean": metric(F.sum, "B", [F.col("g") == "a"], kind="int"),
            "dirty": metric(F.sum, "B", kind="int"),
            "no_rows": metric(F.max, "B", [F.col("g") == "c"], kind="int"),
        },
    )
    assert got.first().asDict() == {"total": 9.0, "clean": 1.0, "dirty": None, "no_rows": 0.0}
    assert len(runs) == 1


def test_a_failure_that_is_not_the_data_is_raised(spark):
    path = fresh_dir(spark, "gone")
    spark.range(4).write.parquet(path)
    df = spark.read.parquet(path)
    for file in glob.glob(f"{path}/*.parquet"):
        os.truncate(file, 4)
    with pytest.raises((PySparkException, Py4JJavaError)):
        quality.metric_set(df, {"total": quality.Metric(F.sum, "id")})

    @F.udf("long")
    def broken(x):
        raise MemoryError("no memory")

    with pytest.raises((PySparkException, Py4JJavaError)):
        quality.metric_set(spark.range(3), {"total": quality.Metric(lambda c: F.sum(broken(c)), "id")})


def test_division_and_overflow_are_data_errors(spark):
    df = spark.createDataFrame([(1, 0), (2, 3)], "a int, b int")
    got = quality.metric_set(
        df,
        {
            "n": quality.Metric(F.count),
            "ratio": quality.Metric(lambda c: F.sum(c / F.col("b")), "a"),
            "product": quality.Metric(lambda c: F.sum(c * F.lit(2**31 - 1)), "a"),
        },
    )
    assert got.first().asDict() == {"n": 2.0, "ratio": None, "product": None}


class _Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


class _Session:
    def __init__(self, **values):
        self.conf = _Conf(**values)


def test_a_cluster_must_name_its_shared_folder():
    assert scratch.shared_root(_Session(spark_checkpoint_dir="s3://bucket/x/", spark_master="yarn")) == "s3://bucket/x"
    assert scratch.shared_root(_Session(spark_master="local[2]")).startswith("/")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(scratch.NoSharedFolder):
            scratch.shared_root(_Session(spark_master=master))


def test_folders_of_a_block_are_removed(spark):
    with scratch.removed_after(spark) as made:
        frame = scratch.frozen(spark.range(3), "gone")
        assert frame.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(made[0])


def test_small_facts_make_a_plain_right_join(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    plan = physical_plan(joins.right_join(labels, documents, "doc_id"))
    assert plan.count("FileScan") == 2 and plan.count("Join") == 1


@pytest.mark.parametrize("facts_fit,lookup_fits", [(True, True), (False, True), (False, False)])
@pytest.mark.parametrize("hot", [1, 10**9])
def test_outer_joins_agree_in_every_form(spark, monkeypatch, facts_fit, lookup_fits, hot):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "k int, f string")
    lookup = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "n")], "k int, l string")
    monkeypatch.setattr(joins, "may_broadcast", lambda df: facts_fit if "f" in df.columns else lookup_fits)
    monkeypatch.setattr(joins, "fits_one_task", lambda df: facts_fit)
    monkeypatch.setattr(joins, "GROUP_ROWS", hot)
    for how in ("right", "full"):
        got = joins.JOINS[how](facts, lookup, "k")
        assert got.columns == ["k", "f", "l"]
        assert sorted(map(str, got.collect())) == sorted(map(str, facts.join(lookup, "k", how).collect()))


def test_top_rows_beyond_the_early_limit(spark):
    rows = spark.range(3000).selectExpr("if(id % 10 = 0, 'b', 'a') AS k", "id % 97 AS v", "id")
    limits = Limits(one_task_bytes=0, group_rows=300)
    for k in (1000, 1001):
        got = win.top_per_group(rows, ["k"], "v", "id", k, limits=limits)
        plain = rows.selectExpr("*", "row_number() over (partition by k order by v desc, id) AS row_num").filter(f"row_num <= {k}")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_windows_over_a_whole_table_refuse_a_large_one(spark, monkeypatch):
    daily = spark.range(5).selectExpr("id AS d", "double(id) AS v")
    assert [r.t for r in win.running_total(daily, "d", "v", "t").orderBy("d").collect()] == [0.0, 1.0, 3.0, 6.0, 10.0]
    monkeypatch.setattr(win, "fits_one_task", lambda df: False)
    with pytest.raises(win.NotDaily):
        win.running_total(daily, "d", "v", "t")


def test_lists_in_long_form(spark):
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "k string, t int, v string")
    got = sorted(map(tuple, listed_long(rows, ["k"], "v", ["t"]).collect()))
    assert got == [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")]


def test_few_rows_of_long_text_are_not_broadcast(spark):
    long = spark.range(20).select("id", F.repeat(F.lit("x"), 1_000_000).alias("t"))
    assert "broadcast" not in broadcast_if_few(long, 20)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in broadcast_if_few(spark.range(20), 20)._jdf.queryExecution().analyzed().toString().lower()
