"""File sources, SQL views and small local tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.sizing import spread_if_small


class MissingInput(FileNotFoundError):
    """A required upstream table does not exist."""


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a folder; a clear error when it is missing."""
    return read_required(spark, f"{folder}/{name}.parquet")


def read_required(spark: SparkSession, path: str, made_by: str | None = None) -> DataFrame:
    """Read Parquet that an earlier step must have written.

    The check is the read itself, so it works on any file system Spark can reach.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            hint = f" Run {made_by} first." if made_by else ""
            raise MissingInput(f"No table at {path}.{hint}") from e
        raise


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One string column ``value``, a row per line."""
    return spark.read.text(path)


def parse_json(lines: DataFrame, schema: StructType | str, column: str = "value") -> DataFrame:
    """JSON text to columns; text that is not JSON gives a row of NULLs."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    parsed = spread_if_small(lines).select(evaluated_once(F.from_json(column, ddl)).alias("record"))
    return parsed.select("record.*")


def with_json_object(lines: DataFrame, column: str, fields: list[str], name: str) -> DataFrame:
    """Adds the named fields of a JSON object as a struct of texts.

    NULL unless the text is exactly one object. Spark's own parser stops at the
    end of the first value; in a list, followed by a mark, text after the object
    is an error too. The mark is a hash of the line, which no line can contain. It also lets single quotes pass unless told not to.
    """
    listed = F.concat(F.lit("["), column, F.lit(', {"_mark": "'), F.md5(F.col(column).cast("binary")), F.lit('"}]'))
    members = ", ".join(f"{f}: string" for f in [*fields, "_mark"])
    found = F.from_json(listed, f"array<struct<{members}>>", {"allowSingleQuotes": "false"})
    parsed = spread_if_small(lines).select("*", evaluated_once(found).alias("_found"))
    alone = (F.size("_found") == 2) & (F.col("_found")[1]["_mark"] == F.md5(F.col(column).cast("binary")))
    return parsed.withColumn(name, F.when(alone, F.col("_found")[0])).drop("_found")


def evaluated_once(expr: Column) -> Column:
    """An expensive expression that is not evaluated again for each use.

    Catalyst moves a filter on a projected column below the projection and copies
    the expression into it, once per use. It does not do so for a generated
    column, so the value goes through an array of one element.
    """
    return F.explode(F.array(expr))


def local_table(spark: SparkSession, rows: Sequence, schema: StructType | str | Iterable[str]) -> DataFrame:
    """A small table held in code.

    ``schema`` is a schema or just the column names, whose types then follow the
    values. For a few hundred rows of reference data; anything that grows belongs
    in a file. Handed over as Arrow, the rows stay in the plan, so Spark knows
    their size and can broadcast them without a hint.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    typed = isinstance(schema, StructType)
    names = schema.names if typed else list(schema)
    table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows])
    return spark.createDataFrame(table, schema) if typed else spark.createDataFrame(table)


def local_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """A small table from dicts, with inferred types and columns sorted by name."""
    names = sorted({name for row in rows for name in row})
    return spark.createDataFrame(pa.Table.from_pylist([{n: row.get(n) for n in names} for row in rows]))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a frame for SQL text and return it."""
    df.createOrReplaceTempView(name)
    return df


def query_view(df: DataFrame, text: str, name: str = "source") -> DataFrame:
    """Run SQL text that names the frame as ``{source}``."""
    return df.sparkSession.sql(text, **{name: df})


def pruned_scan(df: DataFrame, **equal) -> DataFrame:
    """Rows whose partition columns equal the given values."""
    for name, value in equal.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df
