"""Benchmark decontamination by winnowing.

A text is a sequence of lower-case words. Of every ten consecutive words the
least of the six hashes of five consecutive words is kept (of equal ones the
rightmost). Which one is kept depends on these ten words alone, so two texts
that share ten words in a row keep the same hash there: no shared span of ten
words or more is missed, and only about two hashes in seven are looked up.

Kept hashes of documents and benchmark items are joined. A hit is extended: the
windows of ten words that contain its five words are compared with the item
windows in full (by a 128-bit digest of their words). Items of fewer than ten
words are one window each; there the window itself is the hash that is looked up.

A hot hash cannot multiply rows: documents meet the *distinct* hashes and the
*distinct* windows of the benchmark, at most six candidate windows per hit, and
the items behind a window are looked up once for each distinct set of windows
found in some document.

Built-in functions only. Results: a NULL or empty text has no words and no hit;
repeated rows stay repeated; an item without words is no item; equal item ids
count once; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_words, text_key
from tidemark.sources.scratch import frozen

WINDOW = 10
GRAM = 5
# A kept hash is packed with its position: 33 bits of hash above 31 of position.
POSITION = (1 << 31) - 1
# Up to so many distinct hashes and windows (at most about 60 bytes each) go to every executor.
BROADCAST_ROWS = 200_000


def _joined(left: Column, right: Column, by: int) -> Column:
    """Hash of the words of two neighbouring grams, ``by`` words apart."""
    return F.zip_with(left, F.slice(right, by + 1, F.greatest(F.size(right), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def _least(left: Column, right: Column, by: int) -> Column:
    return F.zip_with(left, F.slice(right, by + 1, F.greatest(F.size(right), F.lit(1))), lambda a, b: F.least(a, b))


def _gram_steps(length: int) -> list[tuple[int, int, int]]:
    """How to build hashes of ``length`` words from shorter ones: (length, of which first, then)."""
    if length == 1:
        return []
    first = 1 << ((length - 1).bit_length() - 1)
    steps = [*_gram_steps(first), *_gram_steps(length - first), (length, first, length - first)]
    return list(dict.fromkeys(steps))


def kept_hashes(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``kept``: array of (length, packed), for windows of each of the lengths.

    ``texts`` has a column ``words``. Each step is a projection of its own, so that
    Spark computes every array once.
    """
    steps = list(dict.fromkeys(s for n in lengths for s in _gram_steps(GRAM if n == WINDOW else n)))
    df = texts.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))
    for n, first, then in steps:
        df = df.withColumn(f"g{n}", _joined(F.col(f"g{first}"), F.col(f"g{then}"), first))
    kept = []
    for n in lengths:
        gram, windows = (GRAM if n == WINDOW else n), F.greatest(F.size("words") - (n - 1), F.lit(0))
        grams = F.slice(f"g{gram}", 1, F.greatest(F.size("words") - (gram - 1), F.lit(0)))
        packed = F.transform(
            grams, lambda h, i: h.bitwiseAND(F.lit(~POSITION)).bitwiseOR((F.lit(POSITION) - i).cast("long"))
        )
        if n == WINDOW:
            df = df.withColumn("packed", packed)
            df = df.withColumn("m2", _least(F.col("packed"), F.col("packed"), 1))
            df = df.withColumn("m4", _least(F.col("m2"), F.col("m2"), 2))
            packed = F.array_distinct(F.slice(_least(F.col("m4"), F.col("m2"), 4), 1, windows))
        kept.append(F.transform(packed, _of_length(n)))
    return df.select(*texts.columns, (kept[0] if len(kept) == 1 else F.concat(*kept)).alias("kept"))


def _of_length(n: int):
    return lambda packed: F.struct(F.lit(n).alias("length"), packed.alias("packed"))


def _hash() -> Column:
    return F.shiftright(F.col("k.packed"), 31).alias("hash")


def _position() -> Column:
    return (F.lit(POSITION) - F.col("k.packed").bitwiseAND(F.lit(POSITION))).cast("int").alias("at")


def _window_key(start: Column, length: Column) -> Column:
    words = F.array_join(F.slice("words", start + 1, length), " ")
    return F.unhex(F.md5(words.cast("binary"))).alias("window")


class Benchmark:
    """What is looked up in documents: distinct hashes, distinct windows, and sets of items.

    Written once to the shared folder, since every query uses them several times.
    """

    def __init__(self, benchmark: DataFrame, item: str = "item_id", text: str = "text"):
        items = benchmark.select(
            F.coalesce(benchmark[item].cast("string"), F.lit("")).alias("item"), plain_words(benchmark[text]).alias("words")
        ).filter(F.size("words") > 0)
        items = frozen(items.withColumn("length", F.least(F.size("words"), F.lit(WINDOW))), "bench-items")
        self.lengths = sorted((r[0] for r in items.select("length").distinct().collect()), reverse=True)
        windows = items.select(
            "item", "words", "length", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("start")
        ).select("item", "length", _window_key(F.col("start"), F.col("length")))
        windows = windows.groupBy("window", "length").agg(F.sort_array(F.collect_set("item")).alias("items"))
        windows = windows.withColumn("items_key", F.unhex(F.md5(F.to_json("items").cast("binary"))))
        windows = frozen(windows, "bench-windows")
        self.windows = windows.select("window", "length", "items_key")
        self.items = windows.select("items_key", "items").dropDuplicates(["items_key"])
        hashes = []
        for n in self.lengths:
            own = kept_hashes(items.filter(F.col("length") == n).select("words"), [n])
            hashes.append(own.select(F.explode_outer("kept").alias("k")).select(F.col("k.length").alias("length"), _hash()))
        self.hashes = frozen(reduce(DataFrame.unionAll, hashes).distinct(), "bench-hashes") if hashes else None
        self.few = bool(hashes) and max(self.windows.count(), self.hashes.count()) <= BROADCAST_ROWS


def _candidates(docs: DataFrame, bench: Benchmark) -> DataFrame:
    """(key, words, length, at): places of documents whose kept hash is one of the benchmark's."""
    texts = docs.select(text_key(F.col("text")).alias("key"), plain_words(F.col("text")).alias("words"))
    found = kept_hashes(texts, bench.lengths)
    if bench.few:
        # The words stay in the row while the hash is looked up; only hits are written out.
        looked = found.select("key", "words", F.explode_outer("kept").alias("k"))
        looked = looked.select("key", "words", F.col("k.length").alias("length"), _hash(), _position())
        return looked.join(F.broadcast(bench.hashes), ["length", "hash"], "left_semi")
    # A large benchmark: look up hashes alone, then fetch the words of texts with hits.
    looked = found.select("key", F.explode_outer("kept").alias("k"))
    looked = looked.select("key", F.col("k.length").alias("length"), _hash(), _position())
    hits = looked.join(bench.hashes, ["length", "hash"], "left_semi")
    places = hits.groupBy("key").agg(F.collect_set(F.struct("length", "at")).alias("places"))
    words = texts.join(places, "key")
    return words.select("key", "words", F.explode("places").alias("p")).select("key", "words", "p.length", "p.at")


def hit_texts(docs: DataFrame, bench: Benchmark) -> DataFrame:
    """(key, n_hit, item_sets) for each distinct text with a hit; ``key`` is ``text_key``.

    ``docs`` has a column ``text``.
    """
    places = _candidates(docs, bench)
    last = F.size("words") - F.col("length")
    reach = F.when(F.col("length") == WINDOW, WINDOW - GRAM).otherwise(0)
    starts = F.filter(
        F.sequence(F.col("at") - reach, F.col("at")), lambda s: (s >= 0) & (s <= last)
    )
    rows = places.select("key", "words", "length", F.explode(starts).alias("start"))
    rows = rows.select("key", "length", "start", _window_key(F.col("start"), F.col("length")))
    windows = F.broadcast(bench.windows) if bench.few else bench.windows
    rows = rows.join(windows, ["window", "length"])
    found = rows.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.sort_array(F.collect_set("items_key")).alias("item_sets"),
    )
    state = F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("total"))

    def cover(acc: Column, s: Column) -> Column:
        end = s["start"] + s["length"]
        more = F.greatest(F.lit(0), end - F.greatest(acc["reach"], s["start"]))
        return F.struct(F.greatest(acc["reach"], end).alias("reach"), (acc["total"] + more).alias("total"))

    return found.select(
        "key", F.aggregate("spans", state, cover, lambda acc: acc["total"]).alias("n_hit"), "item_sets"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document: key, ``n_words``, ``n_hit`` (words in a shared window), ``items`` (sorted ids)."""
    texts = docs.select(docs[key].alias("id"), docs[text].cast("string").alias("text"))
    rows = texts.select(
        "id", text_key(F.col("text")).alias("key"), F.size(plain_words(F.col("text"))).cast("long").alias("n_words")
    )
    bench = Benchmark(benchmark, item, item_text)
    if not bench.lengths:
        return rows.select(
            F.col("id").alias(key), "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items")
        )
    hits = frozen(hit_texts(texts, bench), "bench-hits")
    sets = hits.select("item_sets").distinct()
    members = sets.select("item_sets", F.explode("item_sets").alias("items_key")).join(bench.items, "items_key")
    items = members.select("item_sets", F.explode("items").alias("item")).groupBy("item_sets")
    items = items.agg(F.sort_array(F.collect_set("item")).alias("items"))
    known = hits.join(items, "item_sets").select("key", "n_hit", "items")
    return rows.join(known, "key", "left").select(
        F.col("id").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def uncontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The documents that share no window with the benchmark, with all their columns."""
    bench = Benchmark(benchmark, item, item_text)
    if not bench.lengths:
        return docs
    hits = hit_texts(docs.select(docs[text].cast("string").alias("text")), bench).select("key")
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), text_key(docs[text]).alias("key"))
    return whole.join(hits, "key", "left_anti").select("row.*")
