"""Partitioned tables that stay readable: a bounded number of folders, full files.

A table with too many partition values has a folder and a tiny file for each, and
listing them costs more than reading. Two steps keep it from that:

- before the write, ``write_guarded`` counts the values of the partition columns
  by a sketch, and takes coarser columns, or refuses, where there are too many;
- after a write, ``packed`` plans which files of a folder go together and writes
  the table again in files of about one size.

Neither changes rows. ``packed`` writes to another path and leaves the old one as
it is, so readers go on, and a lost executor costs a task; move them to the new
path when it is complete (for instance by ``sources.committed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tidemark.plans.sizing import broadcast_if_few
from tidemark.sources.scratch import frozen
from tidemark.sources.sinks import FILE_BYTES, write_parquet, write_partitioned

# More folders than this are too many for one table.
PARTITIONS = 10_000
# Relative error of the sketch that counts partition values.
SKETCH_ERROR = 0.02
# Coarser forms of a date, finest first.
PERIODS = {"month": "yyyy-MM", "year": "yyyy"}


class TooManyPartitions(ValueError):
    """The partition columns have more values than a table should have folders."""


def layouts(df: DataFrame, by: list[str]) -> list[dict[str, Column]]:
    """Partition columns from fine to coarse: all, then without the last ones, then the period of a leading date, then none."""
    tries = [{c: F.col(c) for c in by[:k]} for k in range(len(by), 0, -1)]
    if isinstance(df.schema[by[0]].dataType, (DateType, TimestampType, TimestampNTZType)):
        tries += [{f"{by[0]}_{name}": F.date_format(by[0], form)} for name, form in PERIODS.items()]
    return [*tries, {}]


def partition_values(df: DataFrame, tries: list[dict[str, Column]], error: float = SKETCH_ERROR) -> list[int]:
    """About how many folders each layout makes. One scan of the partition columns, one sketch per layout and task."""
    # As text in a list, so that a NULL, which has a folder of its own, is counted too.
    counted = [
        F.approx_count_distinct(F.to_json(F.array(*(c.cast("string") for c in columns.values()))), error).alias(f"n{i}")
        for i, columns in enumerate(tries)
        if columns
    ]
    found = iter(df.agg(*counted).first()) if counted else iter(())
    return [next(found) if columns else 1 for columns in tries]


def write_guarded(
    df: DataFrame, path: str, by: list[str], most: int = PARTITIONS, coarsen: bool = True, codec: str = "snappy"
) -> list[str]:
    """Write in folders by the finest layout of at most ``most`` values (within the sketch's error); returns its columns.

    A column that makes no folders stays in the files. Without ``coarsen`` too many
    values are an error, and nothing is written. Where even years are too many the
    rows are laid out by ranges of the first column, so that files still prune.
    """
    tries = layouts(df, by)
    counts = partition_values(df, tries if coarsen else tries[:1])
    if not coarsen and counts[0] > most:
        raise TooManyPartitions(f"about {counts[0]} values of {', '.join(by)}, at most {most} are written")
    chosen = next(columns for columns, n in zip(tries, counts) if n <= most or not columns)
    if not chosen:
        write_parquet(df.repartitionByRange(by[0]), path, codec)
    else:
        write_partitioned(df.withColumns(chosen), path, list(chosen), codec)
    return list(chosen)


def files(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder, bytes) of the data files below a path. Only their names and sizes are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    file = F.col("_metadata.file_path")
    return found.select(file.alias("file"), F.regexp_replace(file, "/[^/]*$", "").alias("folder"), F.col("_metadata.file_size").alias("bytes"))


def packing(found: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """(file, folder, bytes, bin): which files go together, bins counted through all folders from 0.

    The files of a folder are laid end to end, large ones first, and cut every
    ``file_bytes``: a file goes to the bin in which it begins. So a bin holds less
    than ``file_bytes`` besides its last file, no file goes behind one of that size,
    and a folder has no more bins than its bytes fill, rounded up.
    """
    by_size = Window.partitionBy("folder").orderBy(F.desc("bytes"), "file").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("bytes").over(by_size), F.lit(0))
    cut = found.withColumn("at", F.floor(begins / file_bytes))
    # Bins in which no file begins, behind a large file, are left out.
    cut = cut.withColumn("own", (F.dense_rank().over(Window.partitionBy("folder").orderBy("at")) - 1).cast("long")).drop("at")
    # One row per folder, whose number the guard bounds.
    bins = cut.groupBy("folder").agg((F.max("own") + 1).alias("bins"))
    before = Window.orderBy("folder").rowsBetween(Window.unboundedPreceding, -1)
    first = bins.select(F.col("folder"), F.coalesce(F.sum("bins").over(before), F.lit(0)).alias("first"))
    return cut.join(first, "folder").select("file", "folder", "bytes", (F.col("first") + F.col("own")).cast("long").alias("bin"))


def packed(table: DataFrame, path: str, to: str, by: list[str], file_bytes: int = FILE_BYTES, codec: str = "snappy") -> str:
    """Write ``table``, as read from ``path``, to ``to`` in one file per bin of ``packing``; returns the path to read.

    That is ``path`` itself where no two files go together. Each bin is one task, so
    none writes more than a bin, and the rows of a folder meet nowhere else.
    """
    spark = table.sparkSession
    plan = frozen(packing(files(spark, path), file_bytes), "packing")
    n_files, n_bins = plan.agg(F.count(F.lit(1)), F.coalesce(F.max("bin") + 1, F.lit(0))).first()
    if n_files == n_bins:
        return path
    plan = broadcast_if_few(plan.select(F.col("file").alias("_packed_file"), F.col("bin").cast("int").alias("_packed_bin")), n_files)
    rows = table.withColumn("_packed_file", F.col("_metadata.file_path")).join(plan, "_packed_file")
    writer = rows.repartitionById(n_bins, F.col("_packed_bin")).drop("_packed_file", "_packed_bin").write
    writer = writer.mode("overwrite").option("compression", codec)
    (writer.partitionBy(*by) if by else writer).parquet(to)
    return to
