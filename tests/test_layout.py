"""Guarded and packed partitioned tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import layout
from tidemark.sources.scratch import fresh_dir


def days(spark, n_days, a_day=3):
    """Rows of so many days from 2020 on, a few a day."""
    ids = spark.range(n_days * a_day)
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % n_days).cast("int"))
    return ids.select("id", day.alias("day"), F.concat(F.lit("c"), F.floor(F.col("id") / n_days) % 2).alias("country"))


def rows_of(df):
    return sorted((r.id, str(r.day), r.country) for r in df.select("id", "day", "country").collect())


def folders(spark, path):
    return layout.files(spark, path).select("folder").distinct().count()


def test_few_values_are_written_as_asked(spark):
    df, path = days(spark, 10), fresh_dir(spark, "guarded")
    assert layout.write_guarded(df, path, ["day", "country"], most=25) == ["day", "country"]
    assert folders(spark, path) == 20 and rows_of(spark.read.parquet(path)) == rows_of(df)


@pytest.mark.parametrize("most, want", [(500, ["day"]), (50, ["day_month"]), (5, ["day_year"]), (1, [])])
def test_many_tiny_days_are_coarsened(spark, most, want):
    df, path = days(spark, 400), fresh_dir(spark, "guarded")
    assert layout.write_guarded(df, path, ["day", "country"], most=most) == want
    back = spark.read.parquet(path)
    assert folders(spark, path) <= most and rows_of(back) == rows_of(df)
    assert set(back.columns) == {"id", "day", "country", *want}


def test_too_many_are_refused(spark):
    df, path = days(spark, 400), fresh_dir(spark, "guarded")
    with pytest.raises(layout.TooManyPartitions, match=r"about (39|40|41)\d values of day"):
        layout.write_guarded(df, path, ["day"], most=100, coarsen=False)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert layout.write_guarded(df, path, ["day"], most=500, coarsen=False) == ["day"]


def test_nulls_and_empty_tables(spark):
    df = days(spark, 6).withColumn("day", F.when(F.col("id") % 3 > 0, F.col("day")))
    assert layout.partition_values(df, layout.layouts(df, ["day"])) == [5, 2, 2, 1]
    path = fresh_dir(spark, "guarded")
    assert layout.write_guarded(df, path, ["day"]) == ["day"]
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    none, to = fresh_dir(spark, "guarded"), fresh_dir(spark, "packed")
    layout.write_guarded(df.limit(0), none, ["country"])
    assert layout.packed(spark.read.schema(df.schema).parquet(none), none, to, ["country"]) == none


def test_text_columns_without_a_coarser_form(spark):
    df, path = days(spark, 40).withColumn("name", F.sha2(F.col("id").cast("string"), 256)), fresh_dir(spark, "guarded")
    assert layout.write_guarded(df, path, ["name"], most=10) == []
    assert rows_of(spark.read.parquet(path)) == rows_of(df)


def test_plan_of_bins(spark):
    sizes = {"a": [5, 5, 4, 4, 2], "b": [30, 9, 1, 1], "c": [1]}
    rows = [(f"{d}/{i}", d, n) for d, ns in sizes.items() for i, n in enumerate(ns)]
    plan = layout.packing(spark.createDataFrame(rows, "file string, folder string, bytes long"), 10).collect()
    bins = {}
    for r in plan:
        bins.setdefault(r.bin, []).append(r)
    assert sorted(bins) == list(range(len(bins)))
    for held in bins.values():
        assert len({r.folder for r in held}) == 1
        assert sum(r.bytes for r in held) - min(r.bytes for r in held) < 10 or len(held) == 1
    got = {d: sorted(sorted(r.bytes for r in held) for held in bins.values() if held[0].folder == d) for d in sizes}
    assert got == {"a": [[2, 4, 4], [5, 5]], "b": [[1], [1, 9], [30]], "c": [[1]]}


def test_small_files_are_packed(spark):
    df = days(spark, 5, 4_000).withColumn("country", F.when(F.col("id") % 7 > 0, F.concat("country", F.lit(" a/b:%"))))
    path, to = fresh_dir(spark, "loose"), fresh_dir(spark, "packed")
    df.repartition(12).write.partitionBy("day", "country").parquet(path)
    before = layout.files(spark, path).groupBy("folder").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("most"))
    at_most = 2 * before.agg(F.max("most")).first()[0]
    assert layout.packed(spark.read.parquet(path), path, to, ["day", "country"], file_bytes=at_most) == to
    assert rows_of(spark.read.parquet(to)) == rows_of(df) == rows_of(spark.read.parquet(path))
    per_folder = {r.folder.removeprefix("file:").split("/day=")[1]: r for r in before.collect()}
    after = layout.files(spark, to).groupBy("folder").count().collect()
    assert {r.folder.split("/day=")[1] for r in after} == set(per_folder)
    for r in after:
        old = per_folder[r.folder.split("/day=")[1]]
        assert r["count"] <= -(-old.bytes // at_most) < old.n
    # Packed again with bins that all files fill alone, nothing is written.
    assert layout.packed(spark.read.parquet(to), to, fresh_dir(spark, "packed"), ["day", "country"], file_bytes=1) == to
