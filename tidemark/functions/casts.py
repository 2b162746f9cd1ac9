"""Casts that turn bad text into NULL instead of failing the job.

ANSI mode is on by default in Spark 4, so a plain ``cast`` of ``'invalid'`` to
int ends the query. Ingest needs the opposite: keep the row, null the field and
let the validity rule decide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_or_null(c: Column | str) -> Column:
    """Whole-number text to int; ``'1.5'``, ``'invalid'`` and overflow give NULL."""
    return _col(c).try_cast("int")


def double_or_null(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def timestamp_or_null(c: Column | str) -> Column:
    """ISO text to a wall-clock timestamp; bad text gives NULL.

    The zone-free type keeps the result independent of the session time zone.
    """
    return _col(c).try_cast("timestamp_ntz")


def normal_text(c: Column | str, case: str = "lower") -> Column:
    """Trim, then fold the case (``lower`` or ``upper``)."""
    fold = {"lower": F.lower, "upper": F.upper}[case]
    return fold(F.trim(_col(c)))


def flag(predicate: Column) -> Column:
    """A predicate as a boolean that is never NULL."""
    return F.coalesce(predicate, F.lit(False))


def bit(predicate: Column) -> Column:
    """A predicate as 1 or 0; an unknown predicate counts as 0."""
    return F.when(predicate, 1).otherwise(0)


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def _seconds(c: Column | str) -> Column:
    """Exact seconds since 1970 of a zone-free time, to the microsecond."""
    return (_col(c) - _epoch()).cast("interval second").cast("decimal(20,6)")


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since 1970 of a zone-free time."""
    return F.floor(_seconds(c)).cast("long")


def utc_instant(c: Column | str) -> Column:
    """A zone-free time as the instant it names in UTC, whatever the session zone."""
    return F.timestamp_seconds(_seconds(c))


def utc_wall_clock(c: Column | str) -> Column:
    """The zone-free UTC time of an instant."""
    seconds = (F.unix_micros(_col(c)).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return _epoch() + F.make_dt_interval(zero, zero, zero, seconds)
