"""Equi-joins of a fact table with a lookup table.

Output has one key column (USING). The lookup side is broadcast when its size is
known to allow it; otherwise both sides are shuffled and adaptive execution
splits the partitions that hold a hot key.

Spark can neither broadcast the lookup side of a right or full join nor split a
hot fact key in one. With a small lookup side both are put together from the inner
or left join and the lookup rows without a fact. With two large sides Spark's own
join runs, but for the hot fact keys: their facts are dealt over ``salts`` and meet
a copy of the key's few lookup rows in each, so a key with a third of all facts is
joined by many tasks and only lookup rows of hot keys are copied. A NULL key matches
nothing and takes no part in either.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from tidemark.operators.blocks import GROUP_ROWS
from tidemark.plans.sizing import broadcast_if_few, broadcast_if_small, fits_one_task, may_broadcast
from tidemark.sources.scratch import frozen


def inner_join(facts: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    return facts.join(broadcast_if_small(lookup), on, "inner")


def left_join(facts: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """All facts; lookup columns are NULL where nothing matches."""
    return facts.join(broadcast_if_small(lookup), on, "left")


def semi_join(facts: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """Facts that have a match, without lookup columns."""
    return facts.join(broadcast_if_small(lookup), on, "left_semi")


def anti_join(facts: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """Facts without a match, among them facts whose key is NULL."""
    return facts.join(broadcast_if_small(lookup), on, "left_anti")


def _unused(facts: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Lookup rows that no fact refers to.

    The facts are reduced to the distinct keys found in the lookup before they
    are moved, so the hot key of a fact table arrives as one row.
    """
    known = facts.select(*on).join(broadcast_if_small(lookup.select(*on)), on, "left_semi")
    return lookup.join(known.distinct(), on, "left_anti")


def hot_keys(facts: DataFrame, on: str | list[str], rows: int = GROUP_ROWS) -> DataFrame:
    """The keys of more than ``rows`` facts, with their number ``_n``; stored, so that it is counted once.

    At most one key in ``rows`` facts. Counts are combined before the shuffle. A caller
    that joins the same facts again may hand the result on.
    """
    keys = [on] if isinstance(on, str) else on
    counts = facts.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return frozen(counts.filter(F.col("_n") > rows), "hot-keys")


def _dealt(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str, hot: DataFrame, rows: int) -> DataFrame:
    """Right or full join of two large sides, the facts of hot keys dealt over salts."""
    count = hot.count()
    if not count:
        return facts.join(lookup, keys, how)
    salts = broadcast_if_few(hot.select(*keys, F.ceil(F.col("_n") / rows).cast("int").alias("_salts")), count)
    known = broadcast_if_few(hot.select(*keys), count)
    rest = facts.join(known, keys, "left_anti").join(lookup.join(known, keys, "left_anti"), keys, how)
    # By content, so that a task that runs again deals a fact to the same salt.
    content = [f.name for f in facts.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    salted = facts.join(salts, keys).withColumn("_salt", F.pmod(F.xxhash64(*content), F.col("_salts")).cast("int")).drop("_salts")
    every = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt")
    copies = lookup.join(salts, keys).select(*lookup.columns, every)
    # A hot key has facts, so each of its lookup rows has a match; its facts may have none.
    matched = salted.join(copies, [*keys, "_salt"], "inner" if how == "right" else "left").drop("_salt")
    return rest.unionByName(matched.select(*rest.columns))


def right_join(facts: DataFrame, lookup: DataFrame, on: str | list[str], hot: DataFrame | None = None, rows: int = GROUP_ROWS) -> DataFrame:
    """All lookup rows; fact columns are NULL where no fact matches.

    ``hot``: the result of ``hot_keys`` if known; two large sides are counted otherwise.
    """
    keys = [on] if isinstance(on, str) else on
    if may_broadcast(facts):
        return F.broadcast(facts).join(lookup, keys, "right")
    if may_broadcast(lookup):
        return inner_join(facts, lookup, keys).unionByName(_unused(facts, lookup, keys), allowMissingColumns=True)
    hot = hot_keys(facts, keys, rows) if hot is None else hot
    return _dealt(facts.dropna(subset=keys), lookup, keys, "right", hot, rows)


def full_join(facts: DataFrame, lookup: DataFrame, on: str | list[str], hot: DataFrame | None = None, rows: int = GROUP_ROWS) -> DataFrame:
    """All rows of both sides. ``hot`` as in ``right_join``."""
    keys = [on] if isinstance(on, str) else on
    if fits_one_task(facts):
        return facts.join(lookup, keys, "full")
    if may_broadcast(lookup):
        return left_join(facts, lookup, keys).unionByName(_unused(facts, lookup, keys), allowMissingColumns=True)
    hot = hot_keys(facts, keys, rows) if hot is None else hot
    joined = _dealt(facts.dropna(subset=keys), lookup, keys, "full", hot, rows)
    without_key = facts.filter(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys)))
    return joined.unionByName(without_key, allowMissingColumns=True)


JOINS = {
    "inner": inner_join,
    "left": left_join,
    "right": right_join,
    "full": full_join,
    "left_semi": semi_join,
    "left_anti": anti_join,
}


def broadcast_join(facts: DataFrame, lookup: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Inner, left, semi or anti join with a hint, if the lookup side is small enough."""
    return facts.join(broadcast_if_small(lookup), on, how)


def unhinted_join(facts: DataFrame, lookup: DataFrame, on: str, how: str = "left") -> DataFrame:
    """The same rows, with the strategy left to Spark."""
    return facts.join(lookup, on, how)


def facts_per_lookup_row(facts: DataFrame, lookup: DataFrame, on: str, name: str = "n") -> DataFrame:
    """Row count per key of the right join of facts and lookup.

    The facts are counted per key before the join, so only one row per key is
    joined. A key without facts counts its own lookup rows.
    """
    counted = facts.groupBy(on).agg(F.count(F.lit(1)).alias("_facts"))
    rows = lookup.groupBy(on).agg(F.count(F.lit(1)).alias("_lookup_rows"))
    matches = F.coalesce(F.col("_facts"), F.lit(1)) * F.col("_lookup_rows")
    return rows.join(counted, on, "left").select(on, matches.alias(name))


def late_filter(facts: DataFrame, lookup: DataFrame, on: str, tests: list[Column]) -> DataFrame:
    """Join, then filter. Catalyst moves tests on fact columns below the join."""
    joined = left_join(facts, lookup, on)
    for test in tests:
        joined = joined.filter(test)
    return joined


def early_filter(facts: DataFrame, lookup: DataFrame, on: str, tests: list[Column]) -> DataFrame:
    """Filter, then join."""
    for test in tests:
        facts = facts.filter(test)
    return left_join(facts, lookup, on)
