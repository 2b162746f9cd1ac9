"""Exact sums of amounts, rounding and ratios.

A sum of doubles depends on the order in which partial sums meet, so two runs of
one job may differ in the last digit. Amounts are summed as decimals, which is
associative, and turned back into doubles at the end. The decimal keeps six
places and 32 digits before them; what does not fit (NaN, infinities, larger
amounts) counts as no amount and never ends a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 6
# Amounts from here on are not taken for amounts: 10**16 of them fit into one sum.
LARGEST = 10**15


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount(c: Column | str, places: int = PLACES) -> Column:
    """An amount as an exact decimal of ``places`` places; NULL where it does not fit."""
    return _col(c).try_cast(f"decimal(38,{places})")


def representable(c: Column | str) -> Column:
    """Whether a value is absent or an amount that sums can hold, with room for many of its size."""
    return _col(c).isNull() | F.coalesce(F.abs(amount(c)) < F.lit(LARGEST).cast("decimal(38,0)"), F.lit(False))


def money_sum(c: Column | str, where: Column | None = None) -> Column:
    """Exact sum as double. NULLs are skipped; no value at all gives NULL."""
    value = amount(c)
    return F.try_sum(value if where is None else F.when(where, value)).cast("double")


def money_sum_or_zero(c: Column | str, where: Column) -> Column:
    """Sum of the amounts on matching rows; rows that do not match add 0.

    A matching row without an amount adds nothing, and a group that holds
    nothing else has no sum (NULL).
    """
    return F.try_sum(F.when(where, amount(c)).otherwise(amount(F.lit(0)))).cast("double")


def money_avg(c: Column | str) -> Column:
    value = amount(c)
    return F.try_divide(F.try_sum(value).cast("double"), F.count(value))


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``; NULL when ``b`` is 0."""
    return F.try_divide(_col(a), _col(b))


def percent(a: Column | str, b: Column | str) -> Column:
    return ratio(a, b) * 100


def round2(c: Column | str) -> Column:
    """Half-up to two places."""
    return F.round(_col(c), 2)


def percent_change(now: Column, before: Column) -> Column:
    """Change against ``before`` in percent, two places; NULL without a base."""
    return round2(F.try_divide(now - before, before) * 100)
