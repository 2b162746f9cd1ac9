"""Spans of patterns in texts, with built-in functions only.

A span is a struct of ``kind``, ``start``, ``end`` (code points, end exclusive)
and ``found`` (its text). All columns here are arrays of spans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import let

SPAN = "struct<kind:string,start:bigint,end:bigint,found:string>"
NO_SPANS = f"array<{SPAN}>"
# Prefix sums append to arrays of at most so many values, so that their cost stays linear.
BLOCK = 256


def none() -> Column:
    return F.array().cast(NO_SPANS)


def _sums_before(values: Column) -> Column:
    """For each value of a short array the sum of those before it."""
    summed = F.aggregate(
        values, F.array(F.lit(0).cast("long")), lambda acc, v: F.array_append(acc, F.element_at(acc, -1) + v)
    )
    return F.slice(summed, 1, F.size(values))


def sums_before(values: Column) -> Column:
    """For each value of an array of longs the sum of those before it."""

    def in_blocks(v: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
            lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)),
        )
        return let(
            blocks,
            lambda bs: F.flatten(
                F.zip_with(
                    bs,
                    _sums_before(F.transform(bs, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))),
                    lambda b, base: F.transform(_sums_before(b), lambda x: x + base),
                )
            ),
        )

    return F.when(F.size(values) > 0, let(values, in_blocks)).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches of a pattern; ``found`` is the given group.

    The text between matches comes from ``split`` by the same pattern, so a match
    starts where all pieces and matches before it end. Texts without a match cost
    one search.
    """

    def located(between: Column, whole: Column, found: Column) -> Column:
        lengths = F.zip_with(between, whole, lambda b, w: (F.length(b) + F.length(w)).cast("long"))
        starts = F.zip_with(
            sums_before(F.slice(lengths, 1, F.size(whole))), F.slice(between, 1, F.size(whole)), lambda s, b: s + F.length(b)
        )
        return F.zip_with(
            F.arrays_zip(starts.alias("at"), whole.alias("whole")),
            found,
            lambda w, f: F.struct(
                F.lit(kind).alias("kind"),
                w["at"].cast("long").alias("start"),
                (w["at"] + F.length(w["whole"])).cast("long").alias("end"),
                f.alias("found"),
            ),
        )

    def all_matches(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    spans = let(
        F.struct(
            F.split(text, pattern, -1).alias("between"), all_matches(0).alias("whole"), all_matches(group).alias("found")
        ),
        lambda s: located(s["between"], s["whole"], s["found"]),
    )
    return F.when(text.rlike(pattern), spans).otherwise(none())


def in_order(spans: Column, kinds: list[str]) -> Column:
    """By start, then by the place of the kind in ``kinds``, then by end."""
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(kinds) for x in (k, i)))
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("a"), rank[s["kind"]].alias("b"), s["end"].alias("c"), s.alias("span"))
    )
    return F.transform(F.array_sort(keyed), lambda k: k["span"])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, mark: str) -> Column:
    """The text with the union of the spans replaced, one mark for each stretch that touches or overlaps.

    ``spans`` must be in order of start.
    """
    state = "struct<at:bigint,parts:array<string>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")).cast(state)

    def step(acc: Column, s: Column) -> Column:
        fresh = (s["start"] > acc["at"]) | (F.size(acc["parts"]) == 0)
        clean = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["parts"], F.array(clean, F.lit(mark)))).otherwise(acc["parts"]).alias("parts"),
        )

    def finish(acc: Column) -> Column:
        rest = F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(acc["parts"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
