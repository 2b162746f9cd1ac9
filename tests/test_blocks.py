"""Window operators on groups that are cut into blocks.

One key holds most rows, values tie heavily and some are NULL. The limits are set
so low that the group is cut many times; results must equal plain windows.
"""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from compare import difference, spark_rows
from tidemark.operators import windows as win
from tidemark.operators.aggregates import listed
from tidemark.operators.blocks import Limits, split_by_group_size
from tidemark.operators.history import as_of, versions
from tidemark.plans.inspect import physical_plan

TINY = Limits(one_task_bytes=0, group_rows=7)


def rows_with_hot_key(seed, n=160, values=6, nulls=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice([1, 1, 1, 2, 3, None, None])
        value = rng.choice([None, *range(values)] if nulls else list(range(values)))
        rows.append((key, i, value, rng.randint(0, 9), rng.choice(["a", "b", "c", None])))
    rng.shuffle(rows)
    return rows


@pytest.fixture(params=range(2))
def frame(spark, request):
    schema = "k int, id long, v int, t int, name string"
    return spark.createDataFrame(rows_with_hot_key(request.param), schema).repartition(5)


def same(a, b):
    assert difference(spark_rows(a), spark_rows(b.select(*a.columns))) is None


def test_split_keeps_every_row(frame):
    split = split_by_group_size(frame, ["k"], TINY)
    assert split.oversized is not None
    assert split.oversized.count() == split.oversized_rows
    assert split.ordinary.count() + split.oversized_rows == frame.count()
    same(split.ordinary.unionByName(split.oversized), frame)


@pytest.mark.parametrize("descending", [True, False])
def test_ranked(frame, descending):
    way = F.desc if descending else F.asc
    by_value = Window.partitionBy("k").orderBy(way("v"))
    total = Window.partitionBy("k").orderBy(way("v"), "id")
    expected = frame.withColumns(
        {
            "row_num": F.row_number().over(total),
            "rank": F.rank().over(by_value),
            "dense_rank": F.dense_rank().over(by_value),
            "quartile": F.ntile(4).over(total),
        }
    )
    same(win.ranked(frame, ["k"], "v", "id", descending, limits=TINY), expected)


def test_ranked_when_all_values_are_equal(spark):
    frame = spark.range(100).select(F.lit(1).alias("k"), "id", F.lit(5).alias("v"))
    got = win.ranked(frame, ["k"], "v", "id", limits=TINY)
    assert [tuple(r) for r in got.agg(F.max("rank"), F.max("dense_rank"), F.max("row_num")).collect()] == [(1, 1, 100)]


def test_ranked_with_fewer_rows_than_tiles(spark):
    frame = spark.createDataFrame([(1, i, i) for i in range(3)], "k int, id int, v int")
    expected = frame.withColumn("quartile", F.ntile(4).over(Window.partitionBy("k").orderBy(F.desc("v"), "id")))
    got = win.ranked(frame, ["k"], "v", "id", limits=Limits(0, 1))
    same(got.select("k", "id", "v", "quartile"), expected)


def test_neighbours(frame):
    w = Window.partitionBy("k").orderBy("t", "id")
    expected = frame.withColumns(
        {"p": F.lag("name").over(w), "pt": F.lag("t").over(w), "n": F.lead("name").over(w)}
    )
    got = win.neighbours(frame, ["k"], ["t", "id"], {"p": "name", "pt": "t"}, {"n": "name"}, TINY)
    same(got, expected)


@pytest.mark.parametrize("order", ["t", "v"])
def test_running(frame, order):
    amount = frame.withColumn("amount", F.col("v").cast("decimal(18,2)"))
    w = Window.partitionBy("k").orderBy(order)
    expected = amount.withColumns(
        {
            "running_total": F.sum("amount").over(w).cast("double"),
            "running_count": F.count(F.lit(1)).over(w),
            "running_average": F.try_divide(F.sum("amount").over(w).cast("double"), F.count("amount").over(w)),
        }
    )
    same(win.running(amount, ["k"], order, "id", "amount", limits=TINY), expected)


def test_numbered(frame):
    expected = frame.withColumn(
        "row_num", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")).cast("long")
    )
    same(win.numbered(frame, ["k"], ["t", "id"], TINY), expected)


def test_carried_forward(frame):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = frame.withColumn("name", F.last("name", ignorenulls=True).over(w))
    same(win.carried_forward(frame, ["k"], ["t", "id"], "name", TINY), expected)


def test_lists_go_on_in_parts(frame):
    got = listed(frame, ["k"], "v", ["t", "id"], name="vs", list_rows=10, limits=TINY)
    assert got.agg(F.max(F.size("vs"))).first()[0] == 10
    rows = {}
    for r in sorted(got.collect(), key=lambda r: r["part"]):
        rows.setdefault(r["k"], []).extend(r["vs"])
    expected = {}
    for r in sorted(frame.collect(), key=lambda r: (r["t"], r["id"])):
        expected.setdefault(r["k"], []).append(r["v"])
    assert rows == expected


def change_log(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, 3]), i, rng.randint(0, 30), rng.choice("xyz")) for i in range(80)]
    log = spark.createDataFrame(rows, "k int, change int, day int, tier string")
    return log.withColumn("at", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")).cast("timestamp_ntz"))


@pytest.mark.parametrize("seed", range(2))
def test_versions_and_lookup(spark, monkeypatch, seed):
    log = change_log(spark, seed)
    plain = versions(log, "k", "at", "change", ["tier"])
    cut = versions(log, "k", "at", "change", ["tier"], TINY)
    same(cut, plain)
    assert cut.filter("is_current").groupBy("k").count().filter("count <> 1").count() == 0

    rng = random.Random(seed + 50)
    facts = spark.createDataFrame(
        [(rng.choice([1, 1, 1, 2, 9, None]), i, rng.randint(-3, 33)) for i in range(120)], "k int, fact int, day int"
    ).withColumn("at", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")).cast("timestamp_ntz"))
    history = cut.select("k", "valid_from", "valid_to", "tier")
    v = history.select(F.col("k").alias("vk"), "valid_from", "valid_to", "tier")
    expected = facts.join(
        v, (F.col("k") == F.col("vk")) & (F.col("valid_from") <= F.col("at")) & (F.col("at") < F.col("valid_to")), "left"
    ).select(*facts.columns, "tier")
    assert expected.count() == facts.count()
    # written first, so that its size is known to be small or not
    same(as_of(facts, history, "k", "at", ["tier"], ["fact"], TINY), expected)
    from tidemark.operators import history as module

    single = module.one_at_a_time(history, "k", history.schema["valid_from"].dataType, ["tier"])
    kind = history.schema["valid_from"].dataType
    same(module._by_carrying(facts, single, "k", "at", kind, ["tier"], ["fact"], TINY), expected)
    monkeypatch.setattr(module, "may_broadcast", lambda df: True)
    monkeypatch.setattr(module, "VERSIONS_PER_KEY", 1_000)
    for disjoint in (True, False):
        joined = as_of(facts, history, "k", "at", ["tier"], ["fact"], disjoint=disjoint)
        assert "Window" not in physical_plan(joined)  # the versions are stored, not planned again
        same(joined, expected)
    monkeypatch.setattr(module, "VERSIONS_PER_KEY", 1)
    same(as_of(facts, history, "k", "at", ["tier"], ["fact"], TINY, disjoint=True), expected)


@pytest.mark.parametrize("few", [True, False])
def test_lookup_has_one_answer_at_any_size(spark, monkeypatch, few):
    """No start, no end, overlap, zero length, equal starts, dates against times: both ways of the lookup agree."""
    from tidemark.operators import history as module

    monkeypatch.setattr(module, "may_broadcast", lambda df: few)
    history = spark.createDataFrame(
        [
            (1, "2024-01-10 12:00", "2024-01-20 00:00", "a"),
            (1, "2024-01-15 00:00", "2024-01-17 00:00", "b"),  # inside the first: it counts while it lasts, then none
            (1, None, "2024-02-01 00:00", "no start"),
            (1, "2024-01-25 00:00", "2024-01-25 00:00", "zero length"),
            (1, "2024-01-28 00:00", None, "open"),
            (2, "2024-01-01 00:00", "2024-01-05 00:00", "short"),
            (2, "2024-01-01 00:00", "2024-01-09 00:00", "long"),
            (None, "2024-01-01 00:00", None, "no key"),
        ],
        "k int, f string, t string, tier string",
    ).selectExpr("k", "cast(f as timestamp_ntz) AS valid_from", "cast(t as timestamp_ntz) AS valid_to", "tier")
    asked = [
        (1, "2024-01-10", None), (1, "2024-01-11", "a"), (1, "2024-01-15", "b"), (1, "2024-01-18", None), (1, "2024-01-25", None),
        (1, "2024-01-28", "open"), (1, "2030-01-01", "open"), (2, "2024-01-03", "long"), (2, "2024-01-07", "long"),
        (2, "2024-01-09", None), (3, "2024-01-03", None), (None, "2024-01-03", None), (1, None, None),
    ]
    facts = spark.createDataFrame([(i, k, d) for i, (k, d, _) in enumerate(asked)], "fact int, k int, d string")
    facts = facts.selectExpr("fact", "k", "cast(d as date) AS at")
    got = as_of(facts, history, "k", "at", ["tier"], ["fact"], TINY)
    assert got.columns == ["fact", "k", "at", "tier"]
    assert {r.fact: r.tier for r in got.collect()} == {i: tier for i, (_, _, tier) in enumerate(asked)}


def test_a_stored_mark_never_goes_back(spark, tmp_path):
    from tidemark.operators import history as module

    path = str(tmp_path / "mark")
    day = lambda *d: spark.createDataFrame([(x,) for x in d], "d string").selectExpr("cast(d as timestamp) AS t")
    assert module.read_mark(spark, path) is None
    module.save_mark(day("2024-01-02 10:00"), "t", path)
    first = module.read_mark(spark, path)
    module.save_mark(day().limit(0), "t", path)
    module.save_mark(day("2024-01-01 10:00", None), "t", path)
    assert module.read_mark(spark, path) == first
    assert module.since(day("2024-01-02 10:00", "2024-01-02 11:00"), "t", first).count() == 1
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = day("2024-01-02 10:00", "2024-01-02 10:00:01").cache()
    assert rows.count() == 2
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert module.since(rows, "t", module.read_mark(spark, path)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    # A write that died leaves its temporary folder; the mark is still there.
    (tmp_path / "mark" / "_temporary" / "0").mkdir(parents=True)
    assert module.read_mark(spark, path) == first
