"""Where queries register, and the SQL pieces their checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.schemas import CATEGORIES, CATEGORY_ROWS, COUNTRIES, DEVICES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must agree with it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


# --- SQL pieces -----------------------------------------------------------------


def rounded(expr: str, places: int = 2) -> str:
    """Half-up rounding of a double by its decimal digits, as Spark does it."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,18)), {places}) as double)"


def money(expr: str) -> str:
    """Exact sum as double, of more places than the queries keep."""
    return f"cast(sum(cast({expr} as decimal(38,9))) as double)"


def pick(names: list[str], index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {index} {cases} END"


ON_PRODUCT = "event_type IN ('view','click','purchase')"
PAID = "event_type = 'purchase'"

CLICKS = f"""WITH base AS (
  SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM events
), clicks AS (
  SELECT event_id, ts AS event_timestamp, cast(ts AS date) AS event_date,
    cast(extract(hour FROM ts) AS int) AS event_hour,
    cast(extract(dow FROM ts) + 1 AS int) AS day_of_week,
    user_id, event_type,
    {pick(DEVICES, f"k % {len(DEVICES)}")} AS device,
    {pick(COUNTRIES, f"user_id % {len(COUNTRIES)}")} AS country,
    'sess_' || cast(user_id AS varchar) || '_' || cast(k % 5 AS varchar) AS session_id,
    CASE WHEN {ON_PRODUCT} THEN 'prod_' || cast(k AS varchar) END AS product_id,
    CASE WHEN {ON_PRODUCT} THEN {pick(CATEGORIES, f"k % {len(CATEGORIES)}")} END AS category,
    CASE WHEN {ON_PRODUCT} THEN value END AS price,
    CASE WHEN {PAID} THEN 1 + k % 5 END AS quantity,
    CASE WHEN {PAID} THEN {rounded("value * (1 + k % 5)")} END AS total_amount
  FROM base
)"""

# Clicks whose raw record can be parsed, and whether the record is valid.
RECORDS = (
    CLICKS
    + """, records AS (
  SELECT *, event_id % 61 = 0 AS bad_user, event_id % 61 <> 0 AND event_id % 67 = 0 AS bad_time
  FROM clicks WHERE event_id % 97 <> 0
), silver AS (SELECT * FROM records WHERE NOT bad_user AND NOT bad_time)"""
)

CATEGORY_DIM = "dim(category, department, tax_rate) AS (VALUES {})".format(
    ", ".join(f"('{c}', '{d}', cast({t} AS double))" for c, d, t in CATEGORY_ROWS)
)

WORDS = "list_filter(regexp_split_to_array(lower({}), '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '')"
