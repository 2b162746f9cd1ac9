"""Window operators that hold when one group has a third of the rows.

Each takes plain column names and returns the input columns plus its results.
Small inputs, and all groups of ordinary size, use Spark's window functions as
they are; ``operators.blocks`` says what happens to the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.money import amount, money_sum, percent_change, round2
from tidemark.operators.blocks import (
    ROW_IN_BLOCK,
    Limits,
    attach,
    block_order,
    carried,
    in_blocks,
    split_by_group_size,
    summarise,
)
from tidemark.plans.sizing import fits_one_task
from tidemark.sources.scratch import frozen

# Spark's default of windowGroupLimitThreshold: up to here it limits groups before the shuffle.
EARLY_LIMIT = 1_000
BEFORE = (Window.unboundedPreceding, -1)


def _direction(column: str, descending: bool) -> Column:
    return F.desc(column) if descending else F.asc(column)


def _so_far(c: Column, window: Window) -> Column:
    """Sum over all earlier blocks; 0 in the first."""
    return F.coalesce(F.sum(c).over(window.rowsBetween(*BEFORE)), F.lit(0))


def _tile(row: Column, total: Column, tiles: int) -> Column:
    """Which of ``tiles`` near-equal parts a row falls in; the first parts are the larger."""
    size, extra = F.floor(total / tiles), total % tiles
    in_larger = row <= extra * (size + 1)
    return (
        F.when(in_larger, F.floor((row - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor(F.try_divide(row - extra * (size + 1) - 1, size)) + 1)
        .cast("int")
    )


def ranked(
    df: DataFrame,
    keys: list[str],
    value: str,
    tie: str,
    descending: bool = True,
    tiles: int = 4,
    limits: Limits = Limits(),
) -> DataFrame:
    """Adds ``row_num``, ``rank``, ``dense_rank`` (long) and ``quartile`` (int) by ``value``.

    Equal values share ``rank`` and ``dense_rank``; ``tie`` (unique) decides their
    ``row_num`` and ``quartile``.
    """
    by_value = _direction(value, descending)
    total_order = [by_value, F.asc(tie)]

    def inside(part) -> dict[str, Column]:
        return {
            "row_num": F.row_number().over(part.orderBy(*total_order)).cast("long"),
            "rank": F.rank().over(part.orderBy(by_value)).cast("long"),
            "dense_rank": F.dense_rank().over(part.orderBy(by_value)).cast("long"),
        }

    split = split_by_group_size(df, keys, limits)
    part = Window.partitionBy(*keys)
    plain = split.ordinary.withColumns(
        {**inside(part), "quartile": F.ntile(tiles).over(part.orderBy(*total_order))}
    )
    if split.oversized is None:
        return plain

    rows = in_blocks(split, total_order, inside)
    boxed = F.struct(value)  # keeps a NULL value apart from "no such block"
    summary = summarise(
        split,
        rows,
        {
            "n": F.count(F.lit(1)),
            "n_values": F.max("dense_rank"),
            "last_rank": F.max("rank"),
            "first_value": F.min_by(boxed, ROW_IN_BLOCK),
            "last_value": F.max_by(boxed, ROW_IN_BLOCK),
        },
    )
    w = block_order(split)
    # A run of equal values may lie across blocks: it then began in the first
    # block that ends with the value.
    same_end = Window.partitionBy(*keys, "last_value").orderBy("_block")
    carry = (
        summary.withColumns(
            {
                "rows_before": _so_far(F.col("n"), w),
                "values_before": _so_far(F.col("n_values"), w),
                "group_rows": F.sum("n").over(Window.partitionBy(*keys)),
                "continues": F.coalesce(F.lag("last_value").over(w) == F.col("first_value"), F.lit(False)),
            }
        )
        .withColumn("end_run", F.min(F.col("rows_before") + F.col("last_rank")).over(same_end))
        .withColumns(
            {
                "run_rank": F.lag("end_run").over(w),
                "joins": F.sum(F.col("continues").cast("int")).over(w),
            }
        )
        .select(*keys, "_block", "rows_before", "values_before", "group_rows", "continues", "run_rank", "joins")
    )
    whole_row = carried("rows_before") + F.col("row_num")
    in_first_run = carried("continues") & (F.col("rank") == 1)
    blocked = attach(split, rows, carry).select(
        *df.columns,
        whole_row.alias("row_num"),
        F.when(in_first_run, carried("run_rank"))
        .otherwise(carried("rows_before") + F.col("rank"))
        .alias("rank"),
        (carried("values_before") - carried("joins") + F.col("dense_rank")).alias("dense_rank"),
        _tile(whole_row, carried("group_rows"), tiles).alias("quartile"),
    )
    return plain.unionByName(blocked)


def numbered(
    df: DataFrame, keys: list[str], order: list[str], limits: Limits = Limits(), name: str = "row_num"
) -> DataFrame:
    """Adds the row number inside the group. ``order`` must end with a unique column."""
    by = [F.asc(c) for c in order]
    split = split_by_group_size(df, keys, limits)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*by)).cast("long")
    plain = split.ordinary.withColumn(name, number)
    if split.oversized is None:
        return plain
    rows = in_blocks(split, by, lambda part: {})
    carry = summarise(split, rows, {"n": F.count(F.lit(1))}).withColumn(
        "rows_before", _so_far(F.col("n"), block_order(split))
    )
    blocked = attach(split, rows, carry.drop("n")).select(
        *df.columns, (carried("rows_before") + F.col(ROW_IN_BLOCK)).alias(name)
    )
    return plain.unionByName(blocked)


def top_per_group(df: DataFrame, keys: list[str], value: str, tie: str, k: int, descending: bool = True, limits: Limits = Limits()) -> DataFrame:
    """The first ``k`` rows of each group, with their ``row_num``.

    Up to Spark's own limit for this (1,000 rows) every map task keeps ``k`` rows
    per group before the shuffle, so a group of any size arrives small. Beyond it
    the rows are numbered with large groups cut into blocks.
    """
    if k > EARLY_LIMIT:
        rows = ranked(df, keys, value, tie, descending, limits=limits).filter(F.col("row_num") <= k)
        return rows.select(*df.columns, "row_num")
    w = Window.partitionBy(*keys).orderBy(_direction(value, descending), F.asc(tie))
    first = df.withColumn("row_num", F.row_number().over(w)).filter(F.col("row_num") <= k)
    return first.withColumn("row_num", F.col("row_num").cast("long"))


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    before: dict[str, str] | None = None,
    after: dict[str, str] | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Adds values of the previous row (``before``) and of the next (``after``).

    Both map a new column name to the column it is taken from. ``order`` must end
    with a unique column.
    """
    before, after = before or {}, after or {}
    by = [F.asc(c) for c in order]

    def inside(part) -> dict[str, Column]:
        w = part.orderBy(*by)
        return {
            **{new: F.lag(old, 1).over(w) for new, old in before.items()},
            **{new: F.lead(old, 1).over(w) for new, old in after.items()},
        }

    split = split_by_group_size(df, keys, limits)
    plain = split.ordinary.withColumns(inside(Window.partitionBy(*keys)))
    if split.oversized is None:
        return plain

    rows = in_blocks(split, by, inside)
    measures = {"n": F.count(F.lit(1))}
    if before:
        last = F.struct(*(F.col(old).alias(new) for new, old in before.items()))
        measures["last_row"] = F.max_by(last, ROW_IN_BLOCK)
    if after:
        first = F.struct(*(F.col(old).alias(new) for new, old in after.items()))
        measures["first_row"] = F.min_by(first, ROW_IN_BLOCK)
    w = block_order(split)
    carry = summarise(split, rows, measures)
    if before:
        carry = carry.withColumn("row_before", F.lag("last_row").over(w)).drop("last_row")
    if after:
        carry = carry.withColumn("row_after", F.lead("first_row").over(w)).drop("first_row")
    at_start, at_end = F.col(ROW_IN_BLOCK) == 1, F.col(ROW_IN_BLOCK) == carried("n")
    blocked = attach(split, rows, carry).select(
        *df.columns,
        *(F.when(at_start, carried(f"row_before.{c}")).otherwise(F.col(c)).alias(c) for c in before),
        *(F.when(at_end, carried(f"row_after.{c}")).otherwise(F.col(c)).alias(c) for c in after),
    )
    return plain.unionByName(blocked)


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie: str,
    value: str,
    total: str = "running_total",
    rows_so_far: str = "running_count",
    average: str = "running_average",
    limits: Limits = Limits(),
) -> DataFrame:
    """Adds the sum, row count and average of ``value`` up to the current ``order``.

    Rows of equal ``order`` share one result (a RANGE frame). ``value`` must be an
    exact type such as a decimal, so that the result does not depend on how the
    rows are cut; results are a double, a long and a double.
    """
    part_names = {"_sum": F.sum(value), "_rows": F.count(F.lit(1)), "_values": F.count(value)}
    by = F.asc(order)

    def inside(part) -> dict[str, Column]:
        w = part.orderBy(by)
        return {name: agg.over(w) for name, agg in part_names.items()}

    def results() -> list[Column]:
        return [
            F.col("_sum").cast("double").alias(total),
            F.col("_rows").alias(rows_so_far),
            F.try_divide(F.col("_sum").cast("double"), F.col("_values")).alias(average),
        ]

    split = split_by_group_size(df, keys, limits)
    plain = split.ordinary.withColumns(inside(Window.partitionBy(*keys))).select(*df.columns, *results())
    if split.oversized is None:
        return plain

    rows = in_blocks(split, [by, F.asc(tie)], inside)
    names = list(part_names)
    at = F.struct(order)
    parts = F.struct(*names)
    summary = summarise(
        split,
        rows,
        {
            "first_at": F.min_by(at, ROW_IN_BLOCK),
            "last_at": F.max_by(at, ROW_IN_BLOCK),
            "opening": F.min_by(parts, ROW_IN_BLOCK),  # the run of equal times at the start
            "whole": F.max_by(parts, ROW_IN_BLOCK),
        },
    )
    w = block_order(split)
    # Rows of the last time of a block share their result with the rows of the
    # same time that open the blocks after it.
    same_start = (
        Window.partitionBy(*keys, "first_at").orderBy("_block").rowsBetween(0, Window.unboundedFollowing)
    )
    carry = summary.withColumns(
        {
            **{f"before{n}": F.sum(f"whole.{n}").over(w.rowsBetween(*BEFORE)) for n in names},
            **{f"opening{n}": F.sum(f"opening.{n}").over(same_start) for n in names},
        }
    )
    goes_on = F.lead("first_at").over(w) == F.col("last_at")
    carry = carry.withColumns({f"tail{n}": F.when(goes_on, F.lead(f"opening{n}").over(w)) for n in names})
    carry = carry.select(
        *keys, "_block", F.col(f"last_at.{order}").alias("last_time"),
        *(f"before{n}" for n in names), *(f"tail{n}" for n in names),
    )

    def joined(n: str) -> Column:
        tail = F.when(F.col(order).eqNullSafe(carried("last_time")), carried(f"tail{n}"))
        pieces = [carried(f"before{n}"), F.col(n), tail]
        if n != "_sum":
            return sum((F.coalesce(p, F.lit(0)) for p in pieces[1:]), F.coalesce(pieces[0], F.lit(0)))
        zero = F.lit(0).cast("decimal(1,0)")
        added = sum((F.coalesce(p, zero) for p in pieces[1:]), F.coalesce(pieces[0], zero))
        return F.when(F.coalesce(*pieces).isNotNull(), added)

    blocked = attach(split, rows, carry).select(*df.columns, *(joined(n).alias(n) for n in names))
    return plain.unionByName(blocked.select(*df.columns, *results()))


def carried_forward(
    df: DataFrame, keys: list[str], order: list[str], column: str, limits: Limits = Limits()
) -> DataFrame:
    """Replaces ``column`` by its last non-NULL value up to and including the row.

    ``order`` must end with a unique column, or with one whose ties do not matter.
    """
    by = [F.asc(c) for c in order]
    last_known = "_last_known"

    def inside(part) -> dict[str, Column]:
        upto = part.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        return {last_known: F.last(column, ignorenulls=True).over(upto)}

    def finish(frame: DataFrame, value: Column) -> DataFrame:
        return frame.select(*(value.alias(c) if c == column else F.col(c) for c in df.columns))

    split = split_by_group_size(df, keys, limits)
    plain = finish(
        split.ordinary.withColumns(inside(Window.partitionBy(*keys))), F.col(last_known)
    )
    if split.oversized is None:
        return plain
    rows = in_blocks(split, by, inside)
    known = F.when(F.col(column).isNotNull(), F.col(ROW_IN_BLOCK))
    carry = summarise(split, rows, {"known": F.max_by(F.col(column), known)}).withColumn(
        "known_before", F.last("known", ignorenulls=True).over(block_order(split).rowsBetween(*BEFORE))
    )
    blocked = attach(split, rows, carry.drop("known"))
    return plain.unionByName(finish(blocked, F.coalesce(F.col(last_known), carried("known_before"))))


# --- windows over a daily table -------------------------------------------------
#
# These have one group, the whole table. They are meant for a table with one row
# per day, which stays small whatever it was aggregated from; another is refused.


class NotDaily(ValueError):
    """The table is too large to be one with a row per day."""


def _one_group(daily: DataFrame) -> DataFrame:
    """The table itself if its size is known to fit a task, else a stored copy whose size is known."""
    if fits_one_task(daily):
        return daily
    stored = frozen(daily, "daily")
    if not fits_one_task(stored):
        raise NotDaily("A window over the whole table needs one row per day: aggregate by day first.")
    return stored


def daily_sales(sales: DataFrame, day: str, amount: str) -> DataFrame:
    """Revenue and number of orders per day."""
    return sales.groupBy(day).agg(
        money_sum(amount).alias("daily_revenue"), F.count(F.lit(1)).alias("num_orders")
    )


def running_total(daily: DataFrame, day: str, value: str, name: str) -> DataFrame:
    w = Window.orderBy(day)
    return _one_group(daily).withColumn(name, F.try_sum(amount(value)).over(w).cast("double"))


def moving_average(daily: DataFrame, day: str, value: str, name: str, rows: int = 7) -> DataFrame:
    """Average of this row and the ``rows - 1`` before it: rows, not calendar days."""
    w = Window.orderBy(day).rowsBetween(1 - rows, 0)
    exact = amount(value)
    mean = F.try_divide(F.try_sum(exact).over(w).cast("double"), F.count(exact).over(w))
    return _one_group(daily).withColumn(name, round2(mean))


def change_from_previous(daily: DataFrame, day: str, value: str, name: str) -> DataFrame:
    """Percent change against the row before; NULL in the first row."""
    w = Window.orderBy(day)
    return _one_group(daily).withColumn(name, percent_change(F.col(value), F.lag(value, 1).over(w)))
