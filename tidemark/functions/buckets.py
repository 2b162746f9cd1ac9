"""Case expressions that sort values into named classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bounds and names of each class.
HOUR_BUCKETS = [(6, "night"), (12, "morning"), (18, "afternoon")]
LAST_HOUR_BUCKET = "evening"
PRICE_TIERS = [(200, "high"), (50, "medium")]
LOWEST_PRICE_TIER = "low"
USER_SEGMENTS = [(500, "High Value"), (100, "Medium Value"), (0, "Low Value")]
NO_PURCHASE_SEGMENT = "Non-Purchaser"


def _case(tests: list[tuple[Column, str]], default: str) -> Column:
    """Ordered branches: the first test that holds names the class."""
    (first, name), *rest = tests
    case = F.when(first, name)
    for test, name in rest:
        case = case.when(test, name)
    return case.otherwise(default)


def hour_bucket(hour: Column | str) -> Column:
    h = F.col(hour) if isinstance(hour, str) else hour
    return _case([(h < bound, name) for bound, name in HOUR_BUCKETS], LAST_HOUR_BUCKET)


def price_tier(amount: Column | str) -> Column:
    """Tier of an amount; an unknown amount falls to the last tier."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return _case([(a >= bound, name) for bound, name in PRICE_TIERS], LOWEST_PRICE_TIER)


def user_segment(spent: Column | str) -> Column:
    s = F.col(spent) if isinstance(spent, str) else spent
    return _case([(s > bound, name) for bound, name in USER_SEGMENTS], NO_PURCHASE_SEGMENT)
