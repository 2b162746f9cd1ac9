"""Event-time windows. The same functions serve a table and a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import utc_wall_clock


def windowed(
    df: DataFrame, measures: dict[str, Column], time: str = "timestamp", width: str = "5 seconds", late: str = "10 seconds"
) -> DataFrame:
    """Measures per tumbling window of event time.

    On a stream, rows that come more than ``late`` behind the latest time seen are
    dropped and their windows closed; on a table the watermark has no effect.
    """
    return (
        df.withWatermark(time, late)
        .groupBy(F.window(time, width))
        .agg(*(c.alias(n) for n, c in measures.items()))
    )


def windowed_count(df: DataFrame, time: str = "timestamp", width: str = "5 seconds", late: str = "10 seconds") -> DataFrame:
    return windowed(df, {"event_count": F.count(F.lit(1))}, time, width, late)


def flat_window(df: DataFrame) -> DataFrame:
    """Window bounds as two zone-free columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        utc_wall_clock("window.start").alias("window_start"),
        utc_wall_clock("window.end").alias("window_end"),
        *rest,
    )
