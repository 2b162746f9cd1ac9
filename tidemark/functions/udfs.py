"""The two Python forms of a scalar function: by row and by Arrow batch.

Both leave the JVM. ``functions.buckets.price_tier`` is the form to use; these
exist for callers who bring their own Python logic.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions.buckets import LOWEST_PRICE_TIER, PRICE_TIERS

# Fixed value: the share of the price that is left after the discount.
KEPT_SHARE = 0.9


def tier_of(amount: float | None) -> str:
    """Tier of one amount; unlike the built-in form it names the unknown."""
    if amount is None:
        return "unknown"
    return next((name for bound, name in PRICE_TIERS if amount >= bound), LOWEST_PRICE_TIER)


def price_tier_by_row():
    return F.udf(tier_of, "string", useArrow=True)


def discounted():
    @F.pandas_udf("double")
    def keep(amount: pd.Series) -> pd.Series:
        return amount * KEPT_SHARE

    return keep
