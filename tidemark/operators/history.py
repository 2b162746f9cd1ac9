"""Incremental selection, versioned dimensions and point-in-time lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampType

from tidemark.functions.money import percent
from tidemark.operators.blocks import Limits
from tidemark.operators.relational import after
from tidemark.operators.windows import carried_forward, neighbours
from tidemark.plans.sizing import BROADCAST_BYTES, BROADCAST_ROWS, FIXED_WIDTH, fits_one_task, may_broadcast
from tidemark.sources.readers import MissingInput, read_required
from tidemark.sources.scratch import frozen

# Fixed value: the end of a version that is still valid.
OPEN_END = "9999-12-31"

# A lookup table may be joined on its key alone when no key has more versions.
VERSIONS_PER_KEY = 32


# --- incremental selection --------------------------------------------------------


def since(df: DataFrame, column: str, mark: str | None) -> DataFrame:
    """Rows strictly after a high-water mark; all rows without one."""
    return df if mark is None else after(df, column, mark)


def increment_report(df: DataFrame, column: str, mark: str) -> DataFrame:
    """One row: total rows, rows after the mark, their share in percent, the next mark."""
    late = F.col(column) > F.lit(mark).cast(df.schema[column].dataType)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(late).alias("incremental_records"),
        F.max(column).alias("next_mark"),
    )
    share = F.coalesce(F.round(percent("incremental_records", "total_records"), 1), F.lit(0.0))
    return counts.select("total_records", "incremental_records", share.alias("incremental_ratio"), "next_mark")


def as_text(mark: Column, kind: DataType) -> Column:
    """Text that casts back to the same value; an instant carries its offset, so any session zone reads it alike."""
    return F.date_format(mark, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") if isinstance(kind, TimestampType) else mark.cast("string")


def read_mark(spark: SparkSession, path: str) -> str | None:
    """The stored high-water mark, None before the first run."""
    try:
        marks = read_required(spark, path)
    except MissingInput:
        return None
    return marks.agg(as_text(F.max("mark"), marks.schema["mark"].dataType)).first()[0]


def save_mark(df: DataFrame, column: str, path: str) -> str:
    """Add the latest moment of the processed rows to the stored marks.

    The mark is the greatest one stored, so it never goes back: an empty increment
    adds nothing. Marks are appended in their own type; a run that dies while
    writing leaves the earlier ones untouched.
    """
    df.agg(F.max(column).alias("mark")).filter("mark IS NOT NULL").coalesce(1).write.mode("append").parquet(path)
    return path


# --- versioned dimensions ---------------------------------------------------------


def versions(
    changes: DataFrame, key: str, moment: str, tie: str, attributes: list[str], limits: Limits = Limits()
) -> DataFrame:
    """Type 2 history from a change log: every change is a version of its key.

    A version is valid from its own change until the next one (exclusive); the
    last is open and current. ``tie`` is unique and orders changes of one moment.
    Neighbours with equal attributes stay separate versions.
    """
    log = changes.select(key, moment, tie, *attributes)
    following = neighbours(log, [key], [moment, tie], after={"_next": moment}, limits=limits)
    end = F.lit(OPEN_END).cast(log.schema[moment].dataType)
    return following.select(
        key,
        tie,
        *attributes,
        F.col(moment).alias("valid_from"),
        F.coalesce("_next", end).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def as_of(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    moment: str,
    attributes: list[str],
    tie: list[str],
    limits: Limits = Limits(),
    disjoint: bool = False,
) -> DataFrame:
    """The version that is valid at the moment of each fact.

    Of the versions that have started (``valid_from <= t``) the one that started
    last counts, of equal starts the one that ends last; it is valid while ``t <
    valid_to``, and a NULL ``valid_to`` never ends. Versions without a start, and
    versions that end when or before they start, are never valid. Facts without a
    valid version keep NULL attributes. Moments are compared in the wider of the
    two types. ``tie`` names the columns that identify a fact, so that many facts
    of one key and moment can be spread over tasks.

    The history is first brought into this form, one version at a time; a history
    that has it already (as ``versions`` makes it) may say so by ``disjoint``. A small
    one with few versions per key is stored, broadcast and joined on the key, with the
    interval as a condition. Otherwise facts and versions are stacked and, per key
    in time order, the last version is carried to the facts: one shuffle and one sort,
    no pair of fact and version is ever built, and a key with a third of the facts or
    of the versions is cut into blocks. Both give the same rows.
    """
    wide = _wider(facts, moment, history, "valid_from")
    single = _usable(history, key, wide, attributes) if disjoint else one_at_a_time(history, key, wide, attributes, limits)
    if may_broadcast(history):
        single = frozen(single, "versions")
        per_key = single.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(_text_bytes(single, attributes)).alias("bytes"))
        most, rows, size = per_key.agg(F.max("n"), F.sum("n"), F.sum("bytes")).first()
        if (most or 0) <= VERSIONS_PER_KEY and (rows or 0) <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES:
            return _by_interval(facts, F.broadcast(single), key, moment, wide, attributes)
    return _by_carrying(facts, single, key, moment, wide, attributes, tie, limits)


def _wider(left: DataFrame, a: str, right: DataFrame, b: str) -> DataType:
    """The type in which Spark would compare two columns."""
    kinds = left.schema[a].dataType, right.schema[b].dataType
    if kinds[0] == kinds[1]:
        return kinds[0]
    both = F.coalesce(*(F.lit(None).cast(k) for k in kinds)).alias("c")
    return left.sparkSession.range(0).select(both).schema["c"].dataType


def _usable(history: DataFrame, key: str, kind: DataType, attributes: list[str]) -> DataFrame:
    """Versions that are valid at some moment, bounds in the type they are compared in."""
    start, end = F.col("valid_from").cast(kind), F.col("valid_to").cast(kind)
    return history.select(key, start.alias("valid_from"), end.alias("valid_to"), *attributes).filter(
        F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    )


def one_at_a_time(history: DataFrame, key: str, kind: DataType, attributes: list[str], limits: Limits = Limits()) -> DataFrame:
    """(key, valid_from, valid_to, attributes) without overlap: a version ends where the next one starts."""
    usable = _usable(history, key, kind, attributes)
    whole = F.struct("valid_to", *attributes)
    last = F.max_by(whole, F.struct(F.col("valid_to").isNull(), "valid_to", *(F.to_json(F.struct(a)) for a in attributes)))
    once = usable.groupBy(key, "valid_from").agg(last.alias("_v")).select(key, "valid_from", "_v.*")
    following = neighbours(once, [key], ["valid_from"], after={"_next": "valid_from"}, limits=limits)
    return following.select(key, "valid_from", F.least("valid_to", "_next").alias("valid_to"), *attributes)


def _text_bytes(df: DataFrame, attributes: list[str]) -> Column:
    """Bytes of the attributes of one row that have no fixed width."""
    open_ended = [c for c in attributes if not isinstance(df.schema[c].dataType, FIXED_WIDTH)]
    texts = (F.octet_length(c if isinstance(df.schema[c].dataType, StringType) else F.to_json(F.struct(c))) for c in open_ended)
    return sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0))


def _by_interval(
    facts: DataFrame, single: DataFrame, key: str, moment: str, kind: DataType, attributes: list[str]
) -> DataFrame:
    version = single.select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *(F.col(a).alias(f"_v_{a}") for a in attributes)
    )
    at = F.col(moment).cast(kind)
    valid = (F.col(key) == F.col("_key")) & (F.col("_from") <= at) & (F.col("_to").isNull() | (at < F.col("_to")))
    return facts.join(version, valid, "left").select(*facts.columns, *(F.col(f"_v_{a}").alias(a) for a in attributes))


def _by_carrying(
    facts: DataFrame,
    single: DataFrame,
    key: str,
    moment: str,
    kind: DataType,
    attributes: list[str],
    tie: list[str],
    limits: Limits,
) -> DataFrame:
    version = F.struct("valid_to", *attributes)
    moments = single.select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_at"),
        F.lit(0).alias("_kind"),  # a version opens before the facts of its moment
        version.alias("_version"),
    )
    rows = facts.select(
        F.col(key).alias("_key"),
        F.col(moment).cast(kind).alias("_at"),
        F.lit(1).alias("_kind"),
        F.struct(*facts.columns).alias("_fact"),
        *(F.col(c).alias(f"_tie_{c}") for c in tie),
    )
    stacked = moments.unionByName(rows, allowMissingColumns=True)
    if not fits_one_task(stacked):
        # Counting and both kinds of groups read it: stored once rather than joined thrice.
        stacked = frozen(stacked, "as-of")
    carried = carried_forward(stacked, ["_key"], ["_at", "_kind", *(f"_tie_{c}" for c in tie)], "_version", limits)
    # A NULL key groups with itself in a window, yet matches nothing in a lookup; so does a NULL moment.
    until = F.col("_version.valid_to")
    valid = F.col("_key").isNotNull() & F.col("_at").isNotNull() & (until.isNull() | (F.col("_at") < until))
    return carried.filter(F.col("_kind") == 1).select(
        *(F.col(f"_fact.{c}").alias(c) for c in facts.columns),
        *(F.when(valid, F.col(f"_version.{a}")).alias(a) for a in attributes),
    )
