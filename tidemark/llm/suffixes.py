"""Passages that repeat across documents, by sparse suffix arrays.

A text is a sequence of lower-case words. Only suffixes that start at
content-selected positions are kept: of every 43 grams of eight words the one of
least hash (a minimiser). Any passage of 50 words or more holds one, at the same
place in all its copies, so about one suffix in 22 is enough.

Suffixes whose first eight words occur once are dropped. The rest are sorted by
their words, group by group of equal first words, and each is compared with its
neighbours in the order; to the left the words before it are sorted backwards
and compared in the same way. A match is extended word by word to the right and
to the left, up to 50 words each way, and counts if both together reach 50
words. As the next minimiser is at most 43 words away, the extents of
neighbouring matches overlap, and their union is the whole repeated passage.
Where texts that share less stand between two copies in both orders, the windows of
50 words that the longest matches to both sides leave possible are looked up by hash.

Equal texts are handled once; each of two equal texts of 50 words or more is one
long repeat. A group of equal first words may hold a large part of all suffixes:
``windows.neighbours`` then cuts it into blocks.

Results: NULL, empty and short texts have no repeats. Repeated rows are copies of
each other. A passage that repeats inside one text counts too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import text_key
from tidemark.llm.shingles import hashed_words, mixed
from tidemark.operators.windows import neighbours
from tidemark.sources.scratch import frozen

LEAST = 50  # words of a passage
GRAM = 8
SPAN = LEAST - GRAM + 1  # grams of which the least is kept
REACH = 50  # words to each side that are compared
POSITION = np.uint64((1 << 31) - 1)
# Up to so many 16-byte keys of texts go to every executor; beyond that both sides are shuffled.
BROADCAST_ROWS = 500_000

_PLACES = StructType(
    [
        StructField("n_words", LongType()),
        StructField("grams", ArrayType(LongType())),
        StructField("at", ArrayType(IntegerType())),
    ]
)
_CONTEXT = StructType(
    [StructField("at", IntegerType()), StructField("gram", LongType()), StructField("right", StringType()), StructField("left", StringType())]
)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def gram_hashes(words: list[bytes]) -> np.ndarray:
    """A hash of eight words for each place where eight words start."""
    hashes = hashed_words(words)
    total = np.zeros(max(0, len(words) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        total = (total + hashes[k : k + len(total)]) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(total)


def selected(grams: np.ndarray) -> np.ndarray:
    """Places whose gram has the least hash (rightmost of equal ones) of some 43 in a row."""
    if len(grams) < SPAN:
        return np.empty(0, np.int64)
    packed = (grams & ~POSITION) | (POSITION - np.arange(len(grams), dtype=np.uint64))
    least, width = packed, 1
    while width < SPAN:
        step = min(width, SPAN - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    return np.unique((POSITION - (np.unique(least) & POSITION)).astype(np.int64))


@F.arrow_udf(_PLACES)
def places(texts: pa.Array) -> pa.Array:
    counts, grams, at = [], [], []
    for t in texts:
        words = split_words(t.as_py())
        hashes = gram_hashes(words)
        kept = selected(hashes)
        counts.append(len(words))
        grams.append(hashes[kept].view(np.int64))
        at.append(kept.astype(np.int32))
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(grams, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32()))],
        names=["n_words", "grams", "at"],
    )


@F.arrow_udf(ArrayType(_CONTEXT))
def contexts(texts: pa.Array, wanted: pa.Array) -> pa.Array:
    """For each place the words from it on, and the words before it backwards."""
    out = []
    for t, w in zip(texts, wanted):
        words = split_words(t.as_py())
        rows = []
        for place in w.as_py() or ():
            at = place["at"]
            right = b" ".join(words[at : at + REACH]).decode("utf-8", "replace")
            left = b" ".join(words[max(0, at - REACH) : at][::-1]).decode("utf-8", "replace")
            rows.append({"at": at, "gram": place["gram"], "right": right, "left": left})
        out.append(rows)
    return pa.array(out, pa.list_(pa.struct([("at", pa.int32()), ("gram", pa.int64()), ("right", pa.string()), ("left", pa.string())])))


def words_in_common(a: str, b: str) -> int:
    """How many words, separated by one blank each, two texts have in common from the start."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        low = high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    # Of the word in which the texts part, or in which one ends, nothing counts.
    whole = low > 0 and a[low : low + 1] in ("", " ") and b[low : low + 1] in ("", " ")
    return a.count(" ", 0, low) + whole


@F.arrow_udf(IntegerType())
def shared_words(left: pa.Array, right: pa.Array) -> pa.Array:
    """How many words two lists of words have in common from the start."""
    pairs = zip(left.to_pylist(), right.to_pylist())
    return pa.array([None if a is None or b is None else words_in_common(a, b) for a, b in pairs], pa.int32())


def _compared(rows: DataFrame, order: str, name: str) -> DataFrame:
    """Adds an array of (l, r, other): words in common with both neighbours in an order, to the left and right."""
    look = ["right", "left", "least"]
    met = neighbours(
        rows, ["gram"], [order, "text_key", "at"], before={f"b_{c}": c for c in look}, after={f"a_{c}": c for c in look}
    )
    sides = [
        F.struct(
            shared_words(F.col("left"), F.col(f"{side}_left")).alias("l"),
            shared_words(F.col("right"), F.col(f"{side}_right")).alias("r"),
            F.col(f"{side}_least").alias("other"),
        )
        for side in "ba"
    ]
    return met.select(*rows.columns, F.array(*sides).alias(name))


def _matches(rows: DataFrame) -> DataFrame:
    """(text_key, start, end, other) of suffixes that share 50 words or more with another.

    The second order gets the results of the first, not its words, so what is moved again is small.
    """
    both = _compared(_compared(rows, "right", "by_right"), "left", "by_left")
    both = frozen(both.select("text_key", "at", "gram", F.concat("by_right", "by_left").alias("near")), "suffix-near")
    one = both.select("text_key", "at", F.explode("near").alias("m"))
    near = one.filter(F.col("m.l") + F.col("m.r") >= LEAST).select(
        "text_key", (F.col("at") - F.col("m.l")).alias("start"), (F.col("at") + F.col("m.r")).alias("end"), F.col("m.other").alias("other")
    )
    return near.unionAll(_beyond_neighbours(rows, both))


def _beyond_neighbours(rows: DataFrame, both: DataFrame) -> DataFrame:
    """(text_key, start, end, other) of repeats that stand with no neighbour.

    The longest match to each side is that with a neighbour of its order, so a window
    of 50 words repeats only if it lies inside both. Of such windows those that no
    neighbour's match covers are looked up by their words among the suffixes of equal
    first words. Suffixes that stand together in the order to the right and share the
    window form a run, of which the first one answers for all: a form letter in a
    thousand copies sends one window, not a thousand. The others of a run are covered
    by their neighbour, so their own repeat is known already.
    """

    def longest(side: str) -> Column:
        return F.coalesce(F.array_max(F.transform("near", lambda m: m[side])), F.lit(0))

    # A window is named by the number of its words before the place.
    first, last = F.greatest(F.lit(0), LEAST - F.col("right_most")), F.least(F.lit(LEAST - GRAM), F.col("left_most"))
    windows = F.when(first <= last, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<int>"))
    found = both.withColumns({"left_most": longest("l"), "right_most": longest("r")}).withColumn("windows", windows)
    covered = lambda b: F.exists("near", lambda m: F.coalesce((m["l"] >= b) & (m["r"] >= LEAST - b), F.lit(False)))
    asked = found.select("gram", F.explode(F.filter("windows", lambda b: ~covered(b))).alias("before"))
    asked = frozen(asked.distinct(), "suffix-asked")
    if asked.isEmpty():
        return rows.select("text_key", F.col("at").alias("start"), F.col("at").alias("end"), F.col("least").alias("other")).limit(0)

    places = found.join(asked.select("gram").distinct(), "gram", "left_semi")
    # The match with the suffix before it, in the order to the right.
    led = lambda b: F.coalesce((F.col("near")[0]["l"] >= b) & (F.col("near")[0]["r"] >= LEAST - b), F.lit(False))
    leads = F.filter("windows", lambda b: ~led(b))
    places = places.select("text_key", "at", "gram", F.explode(leads).alias("before")).join(asked, ["gram", "before"], "left_semi")
    words = F.concat_ws(
        "\n", F.slice(F.split("left", " "), F.lit(1), F.col("before")), F.lit(""), F.slice(F.split("right", " "), F.lit(1), LEAST - F.col("before"))
    )
    worded = places.join(rows.select("text_key", "at", "right", "left", "least"), ["text_key", "at"])
    worded = frozen(
        worded.select("text_key", "at", "gram", "before", "least", F.unhex(F.md5(words.cast("binary"))).alias("words")), "suffix-windows"
    )
    same = ["gram", "before", "words"]
    groups = worded.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("low"), F.max("least").alias("high"))
    other = F.when(F.col("low") == F.col("least"), F.col("high")).otherwise(F.col("low"))
    start = F.col("at") - F.col("before")
    return worded.join(groups.filter("n > 1"), same).select(
        "text_key", start.alias("start"), (start + LEAST).alias("end"), other.alias("other")
    )


def _merged(spans: Column) -> Column:
    """The union of spans, in order."""
    kind = "array<struct<start:int,end:int>>"

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))),
        )
        fresh = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.when(F.size(acc) == 0, fresh).when(s["start"] <= last["end"], joined).otherwise(F.concat(acc, fresh)).cast(kind)

    return F.aggregate(F.sort_array(spans), F.array().cast(kind), step)


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with a repeat: key, ``n_words``, ``n_repeated`` words, ``spans``, ``others``.

    ``spans`` are ``start``, ``end`` in words (end exclusive), disjoint and in order.
    ``others`` are keys (sorted, without NULL) of texts that share a passage with it:
    of each neighbouring text the least key.
    """
    source = docs.select(docs[key].alias("id"), docs[text].cast("string").alias("text"))
    found = source.select("id", text_key(F.col("text")).alias("text_key"), places(F.col("text")).alias("p"))
    found = frozen(found.select("id", "text_key", "p.*"), "suffix-places")
    texts = found.groupBy("text_key").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("n_words").alias("n_words")
    )
    texts = frozen(texts, "suffix-texts")

    # Places whose first eight words occur elsewhere too, each text once.
    once = found.groupBy("text_key").agg(F.first("grams").alias("grams"), F.first("at").alias("at"))
    once = once.select("text_key", F.explode(F.arrays_zip("grams", "at")).alias("p")).select("text_key", F.col("p.grams").alias("gram"), "p.at")
    shared = once.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    kept = once.join(shared, "gram").groupBy("text_key").agg(F.collect_list(F.struct("gram", "at")).alias("wanted"))
    kept = frozen(kept.join(texts.select("text_key", "least"), "text_key"), "suffix-kept")

    few = kept.count() <= BROADCAST_ROWS
    worded = source.select(text_key(F.col("text")).alias("text_key"), "text")
    met = worded.join(F.broadcast(kept.select("text_key")) if few else kept.select("text_key"), "text_key")
    met = met.groupBy("text_key").agg(F.first("text").alias("text")).join(kept, "text_key")
    rows = met.select("text_key", "least", F.explode(contexts(F.col("text"), F.col("wanted"))).alias("c"))
    rows = frozen(rows.select("text_key", "least", "c.*"), "suffix-rows")

    spans = _matches(rows)
    whole = texts.filter(f"copies > 1 AND n_words >= {LEAST}")
    spans = spans.unionAll(
        whole.select("text_key", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"), F.col("least").alias("other"))
    )
    by_text = spans.groupBy("text_key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"), F.sort_array(F.collect_set("other")).alias("others")
    )
    by_text = by_text.select("text_key", _merged(F.col("spans")).alias("spans"), "others")
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("id", "text_key", "n_words").join(by_text, "text_key").select(
        F.col("id").alias(key), "n_words", total.alias("n_repeated"), "spans", "others"
    )
