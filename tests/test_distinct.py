"""Distinct counts against Spark's own, and bitmaps merged over coarser keys."""

import pytest
from pyspark.sql import functions as F

from compare import difference, spark_rows
from tidemark.operators import distinct
from tidemark.plans.inspect import optimized_plan


@pytest.fixture(scope="module")
def rows(spark):
    ids = spark.range(0, 20_000, 1, 8)
    return ids.select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 5).cast("string")).alias("k"),
        (F.col("id") % 4).cast("int").alias("day"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37) % 90_000 - 45_000).alias("n"),
        F.when(F.col("id") % 13 != 0, F.sha2((F.col("id") % 700).cast("string"), 256)).alias("t"),
        (F.col("id") % 100).cast("decimal(10,2)").alias("v"),
    )


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "day"]])
def test_measured_equals_count_distinct(rows, keys):
    measures = {"rows": F.count(F.lit(1)), "total": F.sum("v"), "least": F.min("t")}
    early = F.when(F.col("day") == 1, F.col("n"))
    apart = {"ids": F.col("n"), "texts": F.col("t"), "early": early}
    got = distinct.measured(rows, keys, measures, apart)
    want = rows.groupBy(*keys).agg(*(c.alias(n) for n, c in measures.items()), *(F.count_distinct(c).alias(n) for n, c in apart.items()))
    assert difference(spark_rows(got), spark_rows(want)) is None
    assert "Expand" not in optimized_plan(got) and "Expand" in optimized_plan(want)
    assert got.columns == want.columns


def test_measured_of_nothing(rows):
    none = rows.filter("day = 9")
    apart = {"ids": F.col("n")}
    assert distinct.measured(none, ["k"], {"rows": F.count(F.lit(1))}, apart).count() == 0
    assert distinct.measured(none, [], {"rows": F.count(F.lit(1))}, apart).first().asDict() == {"rows": 0, "ids": 0}
    only = distinct.measured(rows.filter("n IS NULL"), ["day"], {}, apart)
    assert {r["ids"] for r in only.collect()} == {0} and only.count() == 4


@pytest.mark.parametrize("keys", [["k"], []])
def test_bitmaps_merge_to_exact_counts(rows, keys):
    fine = distinct.id_bitmaps(rows, ["k", "day"], "n")
    want = rows.groupBy(*keys).agg(F.count_distinct("n").alias("ids"))
    assert difference(spark_rows(distinct.distinct_from(fine, keys, "ids")), spark_rows(want)) is None
    coarse = distinct.merged_bitmaps(fine, ["k"])
    assert difference(spark_rows(distinct.distinct_from(coarse, keys, "ids")), spark_rows(want)) is None
    assert coarse.count() <= 7 * 4  # a key has a row per 32,768 ids


def test_bitmaps_at_the_edges_of_blocks(spark):
    ids = [0, 1, -1, 32_767, 32_768, 32_769, -32_767, -32_768, 2**62, -(2**62), None, 0]
    frame = spark.createDataFrame([(i,) for i in ids], "i long")
    assert distinct.distinct_from(distinct.id_bitmaps(frame, [], "i"), [], "n").first()["n"] == 10
    with pytest.raises(ValueError):
        distinct.id_bitmaps(frame.select(F.col("i").cast("string")), [], "i")
