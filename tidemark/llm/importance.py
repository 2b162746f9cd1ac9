"""Importance resampling towards a target: documents drawn by hashed n-gram weights.

Features of a text are its runs of one to three words, joined by one space. The
bucket of a feature is the CRC-32 of its bytes modulo the number of buckets. The
totals per bucket of all source and of all target texts give each bucket a gain (a
log ratio, smoothed by one feature a bucket), the weight of a document is the sum
over its features, and adding Gumbel noise and taking the highest scores draws
documents without replacement in proportion to their weights.

Head and tail. One pass finds frequent words and pairs of words; their CRC states
go to the executors as a broadcast. The CRC of ``a`` followed by ``b`` is the state
after ``a``, advanced by the length of ``b``, xor the CRC of ``b``, so features of
head words are hashed by table look-ups over whole arrays; a frequent pair has its
state at hand. Features with any other word take the CRC of their bytes directly.
Both ways give the same number, so which words are in the head (a bounded summary
per task, the first ``HEAD`` of their sum) changes the speed and no result.

Totals and weights cover every feature of every text: each task adds up a dense
array of buckets, and only these arrays are shuffled. A text of any length is read in
pieces of ``PIECE`` bytes that overlap by two words. What reaches the driver is the
head and one row per bucket.

Results: NULL and empty texts have no words and weight 0. Documents of fewer than
``least_words`` words are never drawn. Ties go to the smaller key, NULL keys (their
noise is that of an empty key) last; rows that are equal in key, too, by the number
of features. Repeated rows stay repeated, other columns are left alone, an empty
table gives an empty table, and an empty target is one without features.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators import windows
from tidemark.operators.blocks import GROUP_ROWS, Limits
from tidemark.sources.scratch import frozen

BUCKETS = 10_000
# Frequent words and pairs: how many are broadcast, how many a task names, and the longest word among them.
HEAD = 1 << 16
NAMED = 1 << 13
HEAD_BYTES = 31
# Bytes of text worked on at once.
PIECE = 1 << 21

SPACE = 0x20


def _word_table() -> bytes:
    """Bytes of words (0-9, a-z, all above ASCII) as they are, A-Z in lower case, all else a space."""
    keep = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    table = bytearray([SPACE] * 256)
    for b in keep:
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 0x20
    return bytes(table)


def _shift_tables(longest: int) -> np.ndarray:
    """For each length and byte place, what a CRC state with that byte becomes after as many zero bytes."""
    bits = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        bits = np.where(bits & 1, (bits >> 1) ^ np.uint32(0xEDB88320), bits >> 1)
    state = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    out = [state]
    for _ in range(longest):
        state = (state >> np.uint32(8)) ^ bits[state & 0xFF]
        out.append(state)
    return np.stack(out)


WORD_TABLE = _word_table()
# A following word is reached over a space.
SHIFTS = _shift_tables(HEAD_BYTES + 1)


def advanced(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC states after ``length`` more zero bytes."""
    out = SHIFTS[length, 0, state & 0xFF]
    for k in (1, 2, 3):
        out ^= SHIFTS[length, k, (state >> np.uint32(8 * k)) & 0xFF]
    return out


@dataclass(frozen=True)
class Words:
    """Words of some texts in order.

    ``doc``: the text of each word. ``before``: how many words before it belong to
    the same text, two at most. ``own``: False for words repeated from the piece
    before, which only begin features.
    """

    words: list[bytes]
    doc: np.ndarray
    before: np.ndarray
    own: np.ndarray


def worded(texts: pa.Array, piece: int = PIECE) -> Iterator[Words]:
    """The words of an array of texts, about ``piece`` bytes at a time."""
    words: list[bytes] = []
    runs: list[tuple[int, int, int]] = []  # text, words, words repeated from before
    size = 0

    def pack() -> Words:
        doc, count, kept = (np.array(c, np.int64) for c in zip(*runs))
        place = np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count)
        return Words(words, np.repeat(doc, count), np.minimum(place, 2), place >= np.repeat(kept, count))

    for i, value in enumerate(texts):
        content = value.as_buffer()
        if content is None or not content.size:
            continue
        data, at, tail = content.to_pybytes().translate(WORD_TABLE), 0, []
        while at < len(data):
            end = len(data)
            if end - at > piece:
                border = data.find(b" ", at + piece)
                end = end if border < 0 else border
            found = data[at:end].split()
            words += tail
            words += found
            runs.append((i, len(tail) + len(found), len(tail)))
            tail = [*tail, *found][-2:]
            size, at = size + end - at, end
            if size >= piece:
                if words:
                    yield pack()
                words, runs, size = [], [], 0
    if words:
        yield pack()


# --- frequent words and pairs ------------------------------------------------------


class Frequent:
    """A bounded summary of what occurs often: counts that are lowered together when there are too many."""

    def __init__(self, size: int):
        self.size = size
        self.counts: dict[bytes, int] = {}

    def add(self, found) -> None:
        counts = self.counts
        for key, n in found:
            counts[key] = counts.get(key, 0) + n
        if len(counts) > 4 * self.size:
            cut = sorted(counts.values(), reverse=True)[2 * self.size]
            self.counts = {k: n - cut for k, n in counts.items() if n > cut}

    def first(self) -> list[tuple[bytes, int]]:
        return sorted(self.counts.items(), key=lambda kn: (-kn[1], kn[0]))[: self.size]


def _frequent_in(part: Words, size: int) -> tuple[list, list]:
    """Frequent words of a piece, and pairs that occur twice in it."""
    counts = Counter(part.words)
    often = counts.most_common(size)
    index = {w: i for i, (w, _) in enumerate(often)}
    ids = np.fromiter(map(index.get, part.words, repeat(-1)), np.int64, len(part.words))
    known = (ids[1:] >= 0) & (ids[:-1] >= 0) & (part.before[1:] > 0) & part.own[1:]
    codes, n = np.unique((ids[:-1] * len(often) + ids[1:])[known], return_counts=True)
    codes, n = codes[n > 1], n[n > 1]
    names = [w for w, _ in often]
    pairs = [(names[c // len(names)] + b" " + names[c % len(names)], k) for c, k in zip(codes.tolist(), n.tolist())]
    return often, pairs


@dataclass(frozen=True)
class Head:
    """Frequent words with their CRC states, and frequent pairs of them by code (first * words + second)."""

    words: list[bytes]
    after: np.ndarray  # CRC of the word alone: the state after it
    spaced: np.ndarray  # CRC of a space and the word
    length: np.ndarray  # bytes of the two
    pairs: np.ndarray
    pair_after: np.ndarray

    @staticmethod
    def of(words: list[bytes], pairs: list[bytes]) -> Head:
        words = [w for w in words if len(w) <= HEAD_BYTES]
        index = {w: i for i, w in enumerate(words)}
        coded = {}
        for pair in pairs:
            a, b = (index.get(w) for w in pair.split(b" "))
            if a is not None and b is not None:
                coded[a * len(words) + b] = crc32(pair)
        codes = sorted(coded)
        return Head(
            words,
            np.array([crc32(w) for w in words], np.uint32),
            np.array([crc32(b" " + w) for w in words], np.uint32),
            np.array([len(w) + 1 for w in words], np.int64),
            np.array(codes, np.int64),
            np.array([coded[c] for c in codes], np.uint32),
        )


def frequent(docs: DataFrame, text: str = "text", head: int = HEAD, named: int = NAMED) -> Head:
    """The head of a corpus: at most ``head`` words and ``head`` pairs."""

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Frequent(named), Frequent(named)
        for batch in batches:
            for part in worded(batch.column(0)):
                often, doubles = _frequent_in(part, 4 * named)
                words.add(often)
                pairs.add(doubles)
        for kind, summary in enumerate((words, pairs)):
            rows = summary.first()
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(rows), pa.int32()), pa.array([k for k, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())],
                names=["kind", "feature", "n"],
            )

    rows = docs.select(docs[text].alias("text")).mapInArrow(summarised, "kind int, feature binary, n long")
    totals = frozen(rows.groupBy("kind", "feature").agg(F.sum("n").alias("n")), "frequent-features")
    first = [
        [bytes(r.feature) for r in totals.filter(F.col("kind") == kind).orderBy(F.desc("n"), "feature").limit(head).collect()]
        for kind in (0, 1)
    ]
    return Head.of(*first)


# --- features ------------------------------------------------------------------------


class Hasher:
    """CRC-32 of all features of texts, by the states of a head and directly for the rest."""

    def __init__(self, head: Head):
        self.head = head
        self.index = {w: i for i, w in enumerate(head.words)}

    def features(self, part: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of one, two and three words: where they end (places in ``part``) and their CRCs."""
        head, words = self.head, part.words
        n = len(words)
        ids = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, n)
        known = ids >= 0
        size = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        joined = b" ".join(words)

        def direct(at: np.ndarray, length: int) -> list[int]:
            return [crc32(joined[a:b]) for a, b in zip(starts[at - length + 1].tolist(), ends[at].tolist())]

        crc = np.zeros(n, np.uint32)  # of the run of ``length`` words that ends at each place
        whole = known
        for length in (1, 2, 3):
            if length == 1:
                crc[known] = head.after[ids[known]]
            else:
                longer = np.zeros(n, np.uint32)
                whole = np.concatenate(([False], whole[:-1])) & known  # all words of the run are in the head
                whole &= part.before >= length - 1
                at = np.flatnonzero(whole)
                last = ids[at]
                if length == 2 and len(head.pairs):
                    codes = ids[at - 1] * len(head.words) + last
                    near = np.minimum(np.searchsorted(head.pairs, codes), len(head.pairs) - 1)
                    often = head.pairs[near] == codes
                    longer[at[often]] = head.pair_after[near[often]]
                    at, last = at[~often], last[~often]
                longer[at] = advanced(crc[at - 1], head.length[last]) ^ head.spaced[last]
                crc = longer
            valid = part.own & (part.before >= length - 1)
            rest = np.flatnonzero(valid & ~whole)
            if len(rest):
                crc[rest] = np.array(direct(rest, length), np.uint32)
            at = np.flatnonzero(valid)
            yield at, crc[at]


def totals(texts: DataFrame, head: Head, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """Features per ``bucket`` (``n``) over all texts; buckets without any are not listed."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, n = Hasher(shared.value), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in worded(batch.column(0)):
                for _, crc in hasher.features(part):
                    n += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["bucket", "n"])

    rows = texts.select(texts[text].alias("text")).mapInArrow(counted, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths of a natural logarithm, rounded down."""

    def dense(counted: DataFrame) -> list[int]:
        n = [0] * buckets
        for r in counted.collect():  # one row per bucket at most
            n[r["bucket"]] = r["n"]
        return n

    s, t = dense(source), dense(target)
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array(
        [math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t)], np.int64
    )


WEIGHED = StructType([StructField(f, LongType()) for f in ("n_words", "weight")])


def weigher(docs: DataFrame, head: Head, gain: np.ndarray):
    """A column function from texts to their number of words and their weight."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))

    @F.arrow_udf(WEIGHED)
    def weighed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher, gain = Hasher(shared.value[0]), shared.value[1]
        for texts in batches:
            n, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for part in worded(texts):
                n += np.bincount(part.doc[part.own], minlength=len(texts))
                for at, crc in hasher.features(part):
                    # Sums of whole numbers far below 2**53, so doubles are exact.
                    sums = np.bincount(part.doc[at], gain[crc % np.uint32(len(gain))], minlength=len(texts))
                    weight += sums.astype(np.int64)
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(weight)], names=["n_words", "weight"])

    return weighed.asNondeterministic()


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise of a key, in thousandths, rounded down: a long."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    seed: int = 42,
    least_words: int = 20,
    buckets: int = BUCKETS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its key, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the documents with ``least_words`` words, ``percent`` of a hundred are drawn,
    rounded down; ``rank`` counts these from 1 and is NULL for all others.
    """
    head = frequent(docs, text)
    gain = gains(totals(docs, head, buckets, text), totals(target, head, buckets, text), buckets)
    rows = docs.select(docs[key].alias("key"), weigher(docs, head, gain)(docs[text]).alias("w"))
    n = F.col("w.n_words")
    scored = frozen(
        rows.select(
            "key",
            (n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("n_features"),
            F.col("w.weight").alias("weight"),
            (F.col("w.weight") + noise(F.col("key"), seed)).alias("score"),
            (n >= least_words).alias("eligible"),
        ),
        "scored",
    )
    columns = ["key", "n_features", "weight", "score"]
    eligible = scored.filter("eligible").select(
        *columns, (-F.col("score")).alias("lowest_first"), F.col("key").isNull().alias("no_key"), F.lit(0).alias("all")
    )
    count = eligible.count()
    # One order over all rows: cut into blocks, whose size follows the number of rows.
    limits = Limits(one_task_bytes=0, group_rows=min(GROUP_ROWS, max(4_096, count // 32)))
    order = ["lowest_first", "no_key", "key", "n_features"]
    ranked = windows.numbered(eligible, ["all"], order, limits, "rank")
    drawn = F.when(F.col("rank") <= percent * count // 100, F.col("rank"))
    others = scored.filter(~F.col("eligible")).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, drawn.alias("rank")).unionByName(others).withColumnRenamed("key", key)
