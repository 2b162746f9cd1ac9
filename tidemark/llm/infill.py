"""Fill-in-the-middle: texts cut at two places and put together in another order.

A text is a sequence of units, a word with the white space before it, and the cuts
are given as unit ranks. An indexable skip list finds them: its lowest lane has a
node per unit with the unit's width in code points, and a node of every lane above
stands for ``FAN`` nodes of the lane below and carries two widths, in units and in
code points. From the top lane down, nodes are passed while the units passed so far
do not exceed the rank, so a rank costs at most ``FAN`` steps a lane, and the code
points passed are the place of the cut.

The places are found in Arrow functions that return three numbers a text; texts
are put together, and taken apart again, by built-in functions.

Results, per row: NULL and empty texts have no units and stay plain, with an empty
output. A NULL key counts as an empty one. Rows of the same key get the same draws.
Repeated rows stay repeated, other columns are left alone, and an empty table gives
an empty table. A text of any length is read in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

FAN = 16
PIECE = 1 << 20
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Where the units of a text end, in code points, from its UTF-8 bytes."""
    found, points, in_word = [], 0, False
    for at in range(0, len(data), PIECE):
        piece = data[at : at + PIECE]
        white = WHITE[piece]
        begun = np.cumsum((piece & 0xC0) != 0x80, dtype=np.int64)
        after_word = np.empty(len(piece), bool)
        after_word[0] = in_word
        np.logical_not(white[:-1], out=after_word[1:])
        found.append(points + begun[np.flatnonzero(after_word & white)] - 1)
        points += int(begun[-1])
        in_word = not white[-1]
    if len(data):
        found.append(np.array([points], np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


class SkipList:
    """Units of a text in lanes; each node carries its width in units and in code points."""

    def __init__(self, widths: np.ndarray):
        units = np.ones(len(widths), np.int64)
        self.lanes = [(units, widths)]
        while len(units) > FAN:
            heads = np.arange(0, len(units), FAN)
            units, widths = np.add.reduceat(units, heads), np.add.reduceat(widths, heads)
            self.lanes.append((units, widths))

    def place(self, rank: int) -> int:
        """Code points before the unit of a rank, and of the whole text for the rank after the last."""
        node = passed = points = 0
        for units, widths in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                points += int(widths[node])
                node += 1
            node *= FAN
        return points


def cut_places(data: bytes | None, draw1: int, draw2: int) -> tuple[int, int, int]:
    """Number of units, and the code points before the first and before the second cut."""
    ends = unit_ends(np.frombuffer(data or b"", np.uint8))
    n = len(ends)
    first, second = sorted((draw1 % (n + 1), draw2 % (n + 1)))
    units = SkipList(np.diff(ends, prepend=0))
    return n, units.place(first), units.place(second)


PLACES = StructType([StructField(f, LongType()) for f in ("n", "first", "second")])


@F.arrow_udf(PLACES)
def places(texts: pa.Array, draws1: pa.Array, draws2: pa.Array) -> pa.Array:
    draws = zip(draws1.to_pylist(), draws2.to_pylist())
    rows = [cut_places(t.as_buffer(), a, b) for t, (a, b) in zip(texts, draws)]
    return pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((), (), ()))], names=["n", "first", "second"]
    )


@dataclass(frozen=True)
class Marks:
    """The control strings before the three parts.

    They must not overlap one another: then the first occurrence of a mark in an
    output is the mark itself, since no text that holds one is cut.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.all
        overlap = any(a.endswith(b[:k]) for a in marks for b in marks for k in range(1, len(b)))
        inside = any(a is not b and a in b for a in marks for b in marks)
        if overlap or inside or not all(marks) or len(set(marks)) < 3:
            raise ValueError(f"marks that overlap or are empty: {marks}")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draw(key: Column, seed: int, number: int) -> Column:
    """The ``number``-th (from 1) group of 32 bits of the SHA-256 of seed and key, as a long."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def infilled(
    docs: DataFrame,
    seed: int = 42,
    rate: int = 50,
    spm_rate: int = 80,
    marks: Marks = Marks(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its key, ``n`` (units), ``form``, ``output`` and the widths of prefix and middle.

    ``rate`` of a hundred texts are cut, of these ``spm_rate`` of a hundred with the
    suffix first (``spm``), the others with the prefix first (``psm``). The widths
    are in code points, NULL if the text stays ``plain``.
    """
    whole = F.coalesce(docs[text], F.lit(""))
    draws = {f"h{i}": draw(docs[key], seed, i) for i in (1, 2, 3, 4)}
    rows = docs.select(
        docs[key].alias("key"),
        whole.alias("text"),
        places.asNondeterministic()(whole, draws["h1"], draws["h2"]).alias("at"),
        draws["h3"].alias("h3"),
        draws["h4"].alias("h4"),
    )
    marked = F.lit(False)
    for mark in marks.all:
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm")
    rows = rows.select("key", "text", "at", form.alias("form"))
    first, second = F.col("at.first"), F.col("at.second")
    prefix = F.substring("text", F.lit(1), first.cast("int"))
    middle = F.substring("text", (first + 1).cast("int"), (second - first).cast("int"))
    suffix = F.substring("text", (second + 1).cast("int"), F.lit(2**31 - 1))
    p, s, m = (F.lit(mark) for mark in marks.all)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    cut = F.col("form") != "plain"
    return rows.select(
        F.col("key").alias(key),
        F.col("at.n").alias("n"),
        "form",
        F.when(cut, first).alias("prefix_chars"),
        F.when(cut, second - first).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The exact text that an output was made of."""

    def part(text: Column, mark: str, number: int) -> Column:
        return F.split_part(text, F.lit(mark), F.lit(number))

    p, s, m = marks.all
    front, middle = part(output, m, 1), part(output, m, 2)
    psm = F.concat(part(part(front, s, 1), p, 2), middle, part(front, s, 2))
    spm = F.concat(part(front, p, 2), middle, part(part(front, p, 1), s, 2))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
