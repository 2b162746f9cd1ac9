"""Byte-level BPE: texts to token ids and back.

A text is cut into pre-tokens by a pattern; each pre-token is merged on its own,
always the pair of lowest rank first and of these the leftmost.

The merge loop keeps a linked list of the pieces of a pre-token and a queue of
its mergeable pairs. The queue has one bucket of positions per merge rank and a
hierarchy of bitmaps over the buckets: a set bit means "something below". The
next rank is found by find-first-set, one word per level, however many pairs
wait. Entries are not removed when a merge changes a neighbouring
pair; a popped entry whose pair has another rank by now is skipped. A pre-token
of n bytes costs O(n log n) and memory O(n), so one of a megabyte is no trouble.

Short pre-tokens of an Arrow batch that are not cached are merged together, in one
queue over all of them: a bucket then holds the positions of a pair in every
pre-token, and its merges are done at once, as array operations. Pre-tokens do not
touch, so that each has its own merges in the same order as in a queue of its own.

Results, per row: NULL and empty texts have no ids and decode to no bytes.
Other columns are left alone, repeated rows stay repeated, and an empty table
gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Merged pre-tokens kept in a worker (twice as many at most), and the longest that is kept. They bound
# the memory of a worker and change no result.
CACHE_ENTRIES = 300_000
CACHE_LENGTH = 48

# Characters of the texts that are cut before their new pre-tokens are merged; the longest pre-token in
# bytes that shares a queue; and the bytes of a shared queue, at most and at least (fewer are merged one by
# one). They bound memory and set the speed, and change no result.
TEXTS = 1 << 24
SHARED_LENGTH = 256
SHARED_MOST = 1 << 20
SHARED_LEAST = 1 << 15


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(token): int(rank) for token, rank in (p for p in pairs if p)}


class RankQueue:
    """The bitmaps of a queue of positions by rank, reused from one pre-token to the next.

    Two levels: a word of ``1 << shift`` bits for as many ranks, and a summary with
    a bit per word. The shift makes both about equally wide. All bits are 0
    between two pre-tokens.
    """

    __slots__ = ("mask", "shift", "words")

    def __init__(self, ranks: int):
        self.shift = max(1, ranks.bit_length() // 2)
        self.mask = (1 << self.shift) - 1
        self.words = [0] * ((ranks >> self.shift) + 1)

    def merge(self, piece: bytes, rank_of) -> list[int]:
        """Where the tokens of a pre-token end: for each start of a token the next one.

        ``rank_of`` gives the rank of a byte string, None if it is no token. The
        queue's steps are written out in place, as they are the inner loop.
        """
        words, shift, mask = self.words, self.shift, self.mask
        n, summary = len(piece), 0
        buckets: dict[int, list[int]] = {}  # rank to a heap of positions
        end = list(range(1, n + 1))  # linked list: where the piece at a position ends
        before = list(range(-1, n - 1))
        current = [rank_of(piece[i : i + 2]) for i in range(n - 1)]  # rank of the pair that starts here
        current.append(None)
        pushed = [(rank, i) for i, rank in enumerate(current) if rank is not None]
        while True:
            for rank, i in pushed:
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    at = rank >> shift
                    words[at] |= 1 << (rank & mask)
                    summary |= 1 << at
            if not summary:
                return end
            # Find-first-set in the summary, then in its word; leftmost position of that rank.
            at = (summary & -summary).bit_length() - 1
            word = words[at]
            low = word & -word
            rank = (at << shift) | (low.bit_length() - 1)
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                words[at] = word = word ^ low
                if not word:
                    summary ^= 1 << at
            pushed = []
            if current[i] != rank:
                continue  # stale: the pair was changed by another merge
            gone = end[i]
            end[i] = after = end[gone]
            current[gone] = current[i] = None
            if after < n:
                before[after] = i
                pair = current[i] = rank_of(piece[i : end[after]])
                if pair is not None:
                    pushed.append((pair, i))
            left = before[i]
            if left >= 0:
                pair = current[left] = rank_of(piece[left:after])
                if pair is not None:
                    pushed.append((pair, left))

    def merge_all(self, pieces: list[bytes], pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many pre-tokens in one queue, end to end, and the number of ids of each.

        A place without a byte stands before, between and after the pre-tokens.
        """
        words, shift, mask = self.words, self.shift, self.mask
        summary = 0
        buckets: dict[int, list[np.ndarray]] = {}  # rank to lists of positions
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        content = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
        n = len(content)
        borders = np.concatenate([[0], np.cumsum(lengths + 1)])
        token = pairs.single[content]
        token[borders] = pairs.none
        owner = np.repeat(np.arange(len(pieces) + 1, dtype=np.int32), np.diff(borders, append=n))
        end = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        alive = np.ones(n, bool)
        alive[borders] = False
        current = pairs.of_bytes(content)  # rank of the pair that starts here
        current[borders] = -1
        current[borders[1:] - 1] = -1
        pushed = by_rank(current, np.arange(n, dtype=np.int32))
        while True:
            for rank, positions in pushed:
                if rank in buckets:
                    buckets[rank].append(positions)
                else:
                    buckets[rank] = [positions]
                    at = rank >> shift
                    words[at] |= 1 << (rank & mask)
                    summary |= 1 << at
            if not summary:
                break
            # Find-first-set in the summary, then in its word; all positions of that rank.
            at = (summary & -summary).bit_length() - 1
            low = words[at] & -words[at]
            rank = (at << shift) | (low.bit_length() - 1)
            lists = buckets.pop(rank)
            words[at] ^= low
            if not words[at]:
                summary ^= 1 << at
            i = lists[0] if len(lists) == 1 else np.concatenate(lists)
            i = i[current[i] == rank]  # without stale ones: the pair was changed by another merge
            if len(i) > 1:
                i.sort()
                i = i[np.concatenate([[True], i[1:] != i[:-1]])]
            pushed = []
            if not len(i):
                continue
            if pairs.at_once[rank]:
                i = apart(i, end[i])
            else:  # A merge can make a pair that comes first: only the leftmost of each pre-token.
                first = np.concatenate([[True], owner[i[1:]] != owner[i[:-1]]])
                if not first.all():
                    pushed.append((rank, i[~first]))
                    i = i[first]
            gone = end[i]
            after = end[gone]
            end[i] = after
            before[after] = i
            token[i] = rank
            alive[gone] = False
            current[gone] = -1
            left = before[i]
            changed = np.concatenate([i, left])
            found = np.concatenate([pairs.ranks(pairs.by_first, rank, token[after]), pairs.ranks(pairs.by_second, rank, token[left])])
            current[changed] = found
            pushed.extend(by_rank(found, changed))
        return token[alive], np.bincount(owner[alive], minlength=len(pieces))[: len(pieces)]


class Pairs:
    """The rank of every pair of tokens that makes a token, listed by its first and by its second token.

    A token goes by its rank; a byte that is no token by a number after all ranks,
    and the place between two pre-tokens, which pairs with nothing, by ``none``.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.none = size = max(ranks.values(), default=0) + 1
        single = [ranks.get(bytes([b]), size + 1 + b) for b in range(256)]
        number = {bytes([b]): n for b, n in enumerate(single)} | ranks
        self.single = np.array(single, np.int32)
        made = [
            (number[token[:k]], number[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in number and token[k:] in number
        ]
        table = np.array(made, np.int32).reshape(-1, 3)
        self.numbers = size + 257
        self.two = np.full(1 << 16, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.two[token[0] << 8 | token[1]] = rank
        self.by_first = self._listed(table[:, 0], table[:, 1], table[:, 2])
        self.by_second = self._listed(table[:, 1], table[:, 0], table[:, 2])
        # Ranks none of whose pairs comes before them: their merges in a pre-token can be done at once.
        first = np.full(self.numbers, self.numbers, np.int32)
        np.minimum.at(first, table[:, 0], table[:, 2])
        np.minimum.at(first, table[:, 1], table[:, 2])
        self.at_once = (first > np.arange(self.numbers)).tolist()
        self.row = np.full(self.numbers, -1, np.int32)  # reused by ``ranks``, all -1 between two calls

    def _listed(self, key: np.ndarray, other: np.ndarray, rank: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        starts = np.searchsorted(key[order], np.arange(self.numbers + 1)).tolist()
        return starts, other[order], rank[order]

    def of_bytes(self, content: np.ndarray) -> np.ndarray:
        """The rank of each byte with the next."""
        wide = content.astype(np.int32)
        return np.append(self.two[wide[:-1] << 8 | wide[1:]], np.int32(-1))

    def ranks(self, listed: tuple[list[int], np.ndarray, np.ndarray], token: int, others: np.ndarray) -> np.ndarray:
        """The ranks of the pairs of a token with others, -1 for those that make no token."""
        starts, other, rank = listed
        some = slice(starts[token], starts[token + 1])
        self.row[other[some]] = rank[some]
        found = self.row[others]
        self.row[other[some]] = -1
        return found


def by_rank(ranks: np.ndarray, positions: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The positions of each rank that is not -1."""
    order = np.argsort(ranks, kind="stable")
    ranks, positions = ranks[order], positions[order]
    cuts = [*(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
    start = 0
    for rank, cut in zip(ranks[[0, *cuts[:-1]]].tolist() if len(ranks) else (), cuts):
        if rank >= 0:
            yield rank, positions[start:cut]
        start = cut


def apart(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of pairs in order, those left when each takes its second token from a pair that starts with it."""
    meets = end[:-1] == start[1:]
    if not meets.any():
        return start
    place = np.arange(len(start))
    chain = np.maximum.accumulate(np.where(np.concatenate([[True], ~meets]), place, 0))
    return start[(place - chain) % 2 == 0]


class Numbers(dict):
    """Keys numbered in order of their first use."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Vocabulary(dict):
    """Merge ranks, and as a dict the packed ids of the pre-tokens seen lately.

    Of two generations the older is forgotten when the younger is full, so that
    frequent pre-tokens stay.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.pairs: Pairs | None = None

    def _keep(self, piece: str, packed: bytes) -> None:
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[piece] = packed

    def packed(self, pieces: list[str]) -> list[bytes]:
        """The packed ids of pre-tokens, all different."""
        found = list(map(self.get, pieces))
        new = []
        for k, piece in enumerate(pieces):
            if found[k] is None:
                found[k] = self.older.get(piece)
                if found[k] is None:
                    new.append(k)
                else:
                    self._keep(piece, found[k])
        for k, ids in zip(new, self.merge_all([pieces[k].encode("utf-8", "replace") for k in new])):
            found[k] = ids
            self._keep(pieces[k], ids)
        return found

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of pre-tokens, short ones merged together."""
        found: list = [None] * len(pieces)
        short, size = [], 0
        for k, piece in enumerate(pieces):
            if piece not in self.ranks and len(piece) <= SHARED_LENGTH:
                short.append(k)
                size += len(piece) + 1
                if size >= SHARED_MOST:
                    self._merge_shared(pieces, short, found)
                    short, size = [], 0
        if size >= SHARED_LEAST:
            self._merge_shared(pieces, short, found)
        for k, piece in enumerate(pieces):
            if found[k] is None:
                ids = self.merge(piece)
                found[k] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _merge_shared(self, pieces: list[bytes], some: list[int], found: list) -> None:
        if self.pairs is None:
            self.pairs = Pairs(self.ranks)
        ids, counts = self.queue.merge_all([pieces[k] for k in some], self.pairs)
        if len(ids) and ids.max() >= self.pairs.none:
            raise KeyError("a byte that is no token")
        content, end = ids.astype("<u4").tobytes(), 0
        for k, n in zip(some, counts.tolist()):
            found[k] = content[end : end + 4 * n]
            end += 4 * n

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        end, ids, i = self.queue.merge(piece, self.ranks.get), [], 0
        while i < len(piece):
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text, packed as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        """The packed ids of each text."""
        encoded: list[bytes] = []
        numbers, cut, size = Numbers(), [], 0

        def join() -> None:
            packed = self.packed(list(numbers))
            encoded.extend(b"".join(map(packed.__getitem__, places)) for places in cut)

        for text in texts:
            cut.append(array("I", map(numbers.__getitem__, self.find(text))) if text else ())
            size += len(text or "")
            if size >= TEXTS:
                join()
                numbers, cut, size = Numbers(), [], 0
        join()
        return encoded

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids or ()))


_loaded: dict[str, Vocabulary] = {}


class Tokenizer:
    """Column functions for one vocabulary.

    ``path`` is read on the driver; its ranks go to the executors as one Spark
    broadcast, whose size is that of the vocabulary, not of the data.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared = spark.sparkContext.broadcast(read_ranks(path))
        self.pattern = pattern
        self.name = uuid.uuid4().hex

    def _loader(self):
        shared, pattern, key = self.shared, self.pattern, self.name

        def load() -> Vocabulary:
            if key not in _loaded:
                _loaded.clear()
                _loaded[key] = Vocabulary(shared.value, pattern)
            return _loaded[key]

        return load

    def encode(self, text: Column) -> Column:
        """array<int>: the ids of a text."""
        load = self._loader()

        @F.arrow_udf("array<int>")
        def ids(texts: pa.Array) -> pa.Array:
            return encode_all(load(), texts)

        # Named nondeterministic so that Spark computes it once where its result is used twice.
        return ids.asNondeterministic()(text)

    def decode(self, ids: Column) -> Column:
        """binary: the bytes that an array of ids stands for; an id outside the vocabulary is an error."""
        load = self._loader()

        @F.arrow_udf("binary")
        def content(arrays: pa.Array) -> pa.Array:
            vocabulary = load()
            return pa.array([vocabulary.decode(a) for a in arrays.to_pylist()], pa.binary())

        return content(ids)

    def encode_checked(self, text: Column) -> Column:
        """struct: the ids of a text, and whether they decode to it.

        One function, as two would keep two workers with a vocabulary each for every task.
        """
        load = self._loader()

        @F.arrow_udf(ENCODED)
        def encoded(texts: pa.Array) -> pa.Array:
            vocabulary = load()
            packed = vocabulary.encode_all(t.as_py() for t in texts)
            same = [
                vocabulary.decode(memoryview(p).cast("I")) == (t.as_py() or "").encode("utf-8", "replace")
                for p, t in zip(packed, texts)
            ]
            return pa.StructArray.from_arrays(
                [id_lists(packed), pa.array(same, pa.bool_())], fields=[pa.field("ids", pa.list_(pa.int32())), pa.field("decodes", pa.bool_())]
            )

        return encoded.asNondeterministic()(text)

    def round_trip(self, text: Column) -> Column:
        """struct: number of ids, SHA-256 of the packed ids, and the bytes the ids decode to.

        The same as ``encode``, ``ids_sha256`` and ``decode``, without the ids leaving the worker.
        """
        load = self._loader()

        @F.arrow_udf(CHECKED)
        def checked(texts: pa.Array) -> pa.Array:
            vocabulary = load()
            packed = vocabulary.encode_all(t.as_py() for t in texts)
            return pa.StructArray.from_arrays(
                [
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    pa.array([vocabulary.decode(memoryview(p).cast("I")) for p in packed], pa.binary()),
                ],
                fields=[pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded", pa.binary())],
            )

        return checked(text)


ENCODED = StructType([StructField("ids", ArrayType(IntegerType())), StructField("decodes", BooleanType())])
CHECKED = StructType(
    [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded", BinaryType())]
)


def encode_all(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
    """A list array of the ids of texts."""
    return id_lists(vocabulary.encode_all(t.as_py() for t in texts))


def id_lists(packed: list[bytes]) -> pa.Array:
    """A list array of ids, built from the packed ids without a Python integer per token."""
    offsets, total = [0], 0
    for p in packed:
        total += len(p) // 4
        offsets.append(total)
    values = pa.Array.from_buffers(pa.int32(), total, [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


@F.arrow_udf(StringType())
def ids_sha256(arrays: pa.Array) -> pa.Array:
    """Lower-case hex SHA-256 of ids as little-endian unsigned 32-bit integers."""
    values = arrays.values.cast(pa.int32())
    view = memoryview(values.buffers()[1] or b"").cast("B")
    starts = [(values.offset + o) * 4 for o in arrays.offsets.to_pylist()]
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(starts, starts[1:])], pa.string())
