"""Data-quality reports and metric sets, each from one pass over the table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.sources.readers import local_table

# The share of NULLs, in percent, at which a column needs review.
NULL_LIMIT_PCT = 1.0
OK, REVIEW, EMPTY, MISSING = "OK", "REVIEW", "EMPTY", "MISSING"
PASSED, NEEDS_REVIEW = "PASSED", "NEEDS REVIEW"


def present(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns that the table has."""
    return [c for c in columns if c in df.columns]


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: a NULL count ``<column>_nulls`` for each column the table has."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in present(df, columns)))


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column: NULLs, their share in percent, and a status.

    ``OK`` below 1%, ``REVIEW`` from 1%, ``EMPTY`` for a table without rows,
    ``MISSING`` for a column the table does not have.
    """
    known = present(df, columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in known)
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                (F.col(c) if c in known else F.lit(None)).cast("long").alias("nulls"),
                F.lit(c in known).alias("_known"),
            )
            for c in columns
        )
    )
    long = counts.select("_rows", F.explode(entries).alias("e")).select("_rows", "e.*")
    pct = F.try_divide(F.col("nulls"), F.col("_rows")) * 100
    status = (
        F.when(~F.col("_known"), MISSING)
        .when(F.col("_rows") == 0, EMPTY)
        .when(pct < NULL_LIMIT_PCT, OK)
        .otherwise(REVIEW)
    )
    return long.select("column", "nulls", pct.alias("null_pct"), status.alias("status"))


def null_gate(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the verdict over all columns the table has."""
    report = null_report(df, columns).filter(F.col("status") != MISSING)
    bad = F.count_if(F.col("status") == REVIEW)
    verdict = F.when(F.count_if(F.col("status") == EMPTY) > 0, EMPTY).when(bad == 0, PASSED).otherwise(NEEDS_REVIEW)
    return report.agg(
        F.count(F.lit(1)).alias("columns_checked"), bad.alias("columns_failed"), verdict.alias("verdict")
    )


@dataclass(frozen=True)
class Metric:
    """An aggregate over one column, restricted to rows that pass all filters.

    With ``kind`` the column is cast to that type first. A row that passes the filters
    and whose value cannot be cast makes the whole metric NULL.
    """

    func: Callable[[Column], Column]
    column: str = "*"
    filters: list[Column] = field(default_factory=list)
    kind: str | None = None

    def expression(self) -> Column:
        """The metric as a double, 0 without a value."""
        source = F.lit(1) if self.column == "*" else F.col(self.column)
        if self.kind is None:
            return self._value(source)
        cast = source.try_cast(self.kind)
        dirty = F.count_if(reduce(lambda a, b: a & b, self.filters, source.isNotNull() & cast.isNull()))
        return F.when(dirty == 0, self._value(cast))

    def _value(self, source: Column) -> Column:
        if self.filters:
            source = F.when(reduce(lambda a, b: a & b, self.filters), source)
        return F.coalesce(self.func(source).cast("double"), F.lit(0.0))


def metric_row(df: DataFrame, metrics: dict[str, Metric]) -> DataFrame:
    """All metrics as one aggregate, planned but not run: one scan whatever their filters.

    A metric that cannot be resolved against the table (its column is missing) is NULL.
    """
    missing = F.max(F.lit(None).cast("double"))
    return df.agg(*((m.expression() if _resolves(df, m) else missing).alias(name) for name, m in metrics.items()))


def metric_set(df: DataFrame, metrics: dict[str, Metric]) -> DataFrame:
    """All metrics in one row, as doubles, from one scan. Runs when it is called.

    A metric without a value is 0. One that cannot be resolved, or whose ``kind`` does
    not fit a row, is NULL, and the scan goes on. If an expression of the caller's own
    fails on the data of some row, the metrics are computed one by one and the failing
    ones are NULL. Any other failure (a lost executor, a missing file, no memory) is no
    statement about the data: it is raised.
    """
    found = _computed(metric_row(df, metrics))
    if found is None:
        found = {}
        for name, metric in metrics.items():
            found |= _computed(metric_row(df, {name: metric})) or {}
    schema = StructType([StructField(name, DoubleType()) for name in metrics])
    return local_table(df.sparkSession, [tuple(found.get(name) for name in metrics)], schema)


def _resolves(df: DataFrame, metric: Metric) -> bool:
    try:
        df.agg(metric.expression())
        return True
    except AnalysisException:
        return False


def _computed(row: DataFrame) -> dict | None:
    """The values of a one-row frame, None if some row's data do not fit an expression."""
    if not row.columns:
        return {}
    try:
        return row.first().asDict()
    except (PySparkException, Py4JJavaError) as e:
        if not is_data_error(e):
            raise
        return None


# SQLSTATE classes for errors of the data (22: data exception, such as a
# bad cast, an overflow or a division by zero; 21: more rows than one).
DATA_STATES = ("22", "21")


def is_data_error(error: Exception) -> bool:
    """Whether a failed job failed on its data, by the SQLSTATE of the error or of what caused it."""
    state = error.getSqlState() if isinstance(error, PySparkException) else None
    if state:
        return state.startswith(DATA_STATES)
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        if is_instance_of(SparkContext._gateway, cause, "org.apache.spark.SparkThrowable") and cause.getSqlState():
            return cause.getSqlState().startswith(DATA_STATES)
        cause = cause.getCause()
    return False
