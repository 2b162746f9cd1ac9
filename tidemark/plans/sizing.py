"""Size checks that choose between a plan for small and a plan for large input.

Sizes come from the statistics Catalyst keeps for its own join choice (file
sizes, scaled by the columns read). They cost no job. Where no statistic exists
the input counts as large, so the plan that scales is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

UNKNOWN = 1 << 62
MB = 1 << 20

# An input of at most this many bytes on disk fits one task whole, whatever its keys.
ONE_TASK_BYTES = 64 * MB
# A table of at most this many bytes may be sent to every executor.
BROADCAST_BYTES = 16 * MB
# The same limit for tables whose row count, not size, is known.
BROADCAST_ROWS = 500_000
FIXED_WIDTH = (NumericType, BooleanType, DatetimeType)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame, ``UNKNOWN`` where there is none."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return UNKNOWN


def fits_one_task(df: DataFrame, limit: int = ONE_TASK_BYTES) -> bool:
    return estimated_bytes(df) <= limit


def spread_if_small(df: DataFrame, *by: str) -> DataFrame:
    """Spread a small input over all cores, by the given columns if any.

    A small file is one scan task, which leaves the other cores idle during heavy
    work on each row. A large input already comes in many tasks and is left as it
    is.
    """
    if not fits_one_task(df):
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *by)


def may_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return estimated_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a frame for broadcast when its estimate allows it.

    Above the limit the frame stays unmarked: Spark then shuffles both sides, and
    adaptive execution splits the partitions that hold a hot key.
    """
    return F.broadcast(df) if may_broadcast(df, limit) else df


def broadcast_if_few(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The same for a frame whose row count the caller has counted or can bound.

    Rows of fixed width are bounded by their number. Texts and other values of any
    length are measured first, by one pass over the few rows.
    """
    if rows > limit:
        return df
    if any(not isinstance(f.dataType, FIXED_WIDTH) for f in df.schema.fields):
        size = df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
        if size > BROADCAST_BYTES:
            return df
    return F.broadcast(df)
